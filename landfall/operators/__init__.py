"""DataFrame to DataFrame steps of a load."""

"""Where lines come from and where good rows, failed events and the batch log go."""

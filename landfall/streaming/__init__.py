"""Structured Streaming: the load itself, and the table over the landing folder."""

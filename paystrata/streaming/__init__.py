"""Structured Streaming queries. Each ``start_…`` function returns the running
query; the caller waits for it or stops it."""

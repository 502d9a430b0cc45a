"""Structured Streaming twins of the incremental batch steps."""

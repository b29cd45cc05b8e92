"""Structured Streaming variants of the incremental loads."""

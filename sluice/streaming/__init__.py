"""Structured Streaming forms of the incremental operations."""

"""Incremental refresh with Structured Streaming."""

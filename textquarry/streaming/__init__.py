"""Restartable incremental processing on Structured Streaming."""

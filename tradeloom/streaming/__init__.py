"""Incremental runs of the same jobs with Structured Streaming."""

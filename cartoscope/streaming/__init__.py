"""Incremental, resumable processing with Structured Streaming."""

"""Incremental runs over newly arrived files (Structured Streaming)."""

"""Structured Streaming jobs (bronze archive)."""

"""Restartable copies on Structured Streaming."""

"""Structured Streaming jobs: load only new files, clean each micro-batch."""

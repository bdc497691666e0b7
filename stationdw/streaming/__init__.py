"""Structured Streaming jobs over the raw message topic."""

"""Structured Streaming jobs over a landing zone of position files."""

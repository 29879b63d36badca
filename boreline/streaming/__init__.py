"""Structured Streaming jobs over a feed of readings."""

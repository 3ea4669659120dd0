"""Structured Streaming jobs over the tape."""

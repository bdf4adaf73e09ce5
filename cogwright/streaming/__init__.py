"""Structured Streaming jobs over file drops."""

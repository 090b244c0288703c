"""Structured Streaming from topics to the raw layer."""

"""Structured Streaming arrival of raw files."""

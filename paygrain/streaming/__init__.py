"""Structured Streaming forms of the monthly intake."""

"""Structured Streaming upkeep of the store."""

"""Structured Streaming form of the daily card checks."""

"""Readers, writers, and the mapping from the shared test tables."""

"""Staging of intermediate tables and the catalogue of named queries."""

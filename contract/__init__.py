"""Queries the engine is checked with, on documents derived from relational tables."""

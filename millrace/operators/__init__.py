"""Checks, merge, deduplication, flattening."""

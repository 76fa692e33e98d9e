"""Readers for landed files and the catalog."""

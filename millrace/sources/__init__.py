"""Readers for landed files and nested records."""

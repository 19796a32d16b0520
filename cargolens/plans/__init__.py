"""Composed reports over a cleaned import table."""

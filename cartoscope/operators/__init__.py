"""Relational operators of the catalogue search."""

"""Queries over the given tables, each with independent SQL to check it."""

"""Queries over the given tables, each with its reference SQL where SQL can express it."""

"""Operators for preparing training data: filters, near-duplicate search, mixing and token output."""

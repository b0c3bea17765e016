"""Operators for building training text: extraction, cleaning, deduplication, tokens, search."""

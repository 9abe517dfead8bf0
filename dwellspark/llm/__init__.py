"""Operators for preparing training text: language, shuffling, cleaning, deduplication, search, tokens."""

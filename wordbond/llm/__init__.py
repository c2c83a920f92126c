"""Operators for preparing training data: deduplication, tokens, scoring, packing."""

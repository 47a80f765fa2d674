"""Operators for preparing training text: dedup, packing, personal data, toxicity, search."""

"""Operators of a large training-data pipeline: quality, toxicity, duplicates, tokens, packing, search."""

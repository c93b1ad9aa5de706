"""Operators for large training corpora: sharding, deduplication, filtering, tokens."""

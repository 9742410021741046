"""Operators for preparing training data: deduplication, filtering, tokens, archives, shards."""

"""Operators that prepare training data: deduplication, filters, scores, mixing and sharding."""

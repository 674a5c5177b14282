"""Operators that prepare training data: cleaning, deduplication, scoring, packing and sharding."""

"""Operators for training-data corpora: scoring, counting, deduplication, mixing, sharding and packing."""

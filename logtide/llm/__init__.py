"""Operators for preparing training data: search, deduplication, mixing, packing, classification, scrubbing, sharding."""

"""Operators for training data: archives, sharding, filters, counts, duplicates, scores, packing."""

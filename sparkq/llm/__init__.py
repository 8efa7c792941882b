"""Operators over training-data corpora: filters, deduplication, search, packing."""

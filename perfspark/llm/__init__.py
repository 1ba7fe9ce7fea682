"""Operators of a training-data pipeline: search, filters, deduplication, packing, scoring."""

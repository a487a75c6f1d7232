"""Operators of a training-data pipeline: dedup, filters, scoring, packing, sharding, counts."""

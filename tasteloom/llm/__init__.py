"""Operators for training-data pipelines: deduplication, filtering, mixing and writing."""

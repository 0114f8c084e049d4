"""Structured Streaming jobs; the work of each batch is in ``operators``."""

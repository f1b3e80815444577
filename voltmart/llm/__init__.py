"""Operators for preparing training data: deduplication, packing, search, scoring, extraction."""

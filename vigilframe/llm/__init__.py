"""Operators for preparing training data: extraction, dedup, filtering, mixing and packing."""

"""Operators for large training corpora: scoring, filtering, deduplication, mixing, formatting."""

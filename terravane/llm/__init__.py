"""Operators for large text corpora: deduplication, screening, scoring and packing.

Nothing outside this folder imports it.
"""

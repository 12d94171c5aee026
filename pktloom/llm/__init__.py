"""Training-data operators: scoring, deduplication, scanning, packing and extraction of text.

Nothing outside this package imports it.
"""

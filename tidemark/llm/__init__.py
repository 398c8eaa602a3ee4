"""Training-data operators: mixing, deduplication, filtering, search, scoring and output.

Nothing outside this folder imports it.
"""

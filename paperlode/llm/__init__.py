"""Training-data operators: search, deduplication, filtering and tokenization at corpus scale.

Nothing outside this subpackage imports it.
"""

"""Training-data operators: quality, safety, deduplication, tokenisation and packing."""

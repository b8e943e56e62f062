"""Training-data operators: tokens, filters, dedup, search and packing."""

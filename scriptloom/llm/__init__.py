"""Training-data operators: tokens, quality, toxicity, near-duplicates, line deduplication, packing."""

"""Training-data operators: quality, near-duplicates, toxicity, chat, packing, tokens, URL filters."""

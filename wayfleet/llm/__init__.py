"""Training-data operators: sharding, deduplication, search, tokens, filters, mixing, privacy and quality."""

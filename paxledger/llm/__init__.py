"""Training-data operators: deduplication, quality, leaks, secrets, archives, sharding, packing, chat."""

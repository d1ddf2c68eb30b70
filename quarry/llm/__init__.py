"""Training-data operators: tokenising, deduplication, mixing, filtering and search at corpus scale."""

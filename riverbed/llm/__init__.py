"""Training-data operators: scoring, salvage, deduplication, filtering, mixing."""

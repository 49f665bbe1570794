"""Training-data operators: tokenizing, deduplication, scoring, filtering, search."""

"""Training-data operators: deduplication, filtering, tokenisation and archives over document tables."""

"""Training-data operators: filtering, deduplication, tokenising and packing of text corpora."""

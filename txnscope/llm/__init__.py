"""Training-data operators: deduplication, filtering, tokenising, packing and encoding of a text corpus."""

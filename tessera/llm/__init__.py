"""Training-data operators: tokenising, near-dedup, filtering, packing, search and chat layout."""

"""Training-data operators: retrieval, packing, near-duplicates, filters, tokenizing, scoring."""

"""Training-data operators: tokenising, packing, near and exact dedup, ANN, scoring, sharding, WARC."""

"""Training-data operators: dedup, filters, tokenisation, extraction and search over text tables."""

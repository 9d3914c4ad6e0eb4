"""Training-data operators: fingerprints, deduplication, models, tokenisation, mixing."""

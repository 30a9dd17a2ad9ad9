"""Training-data operators: toxicity, deduplication, extraction, fingerprints,
tokenization, mixing, licence scans and language identification."""

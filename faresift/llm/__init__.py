"""Training-data operators: deduplication, filters, classifiers, extraction, formatting and packing."""

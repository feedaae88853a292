"""Training-data operators: filters, deduplication, packing, formats, PII."""

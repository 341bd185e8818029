"""Table-level operators: deduplication, key resolution, lookups, sampling rates, quality checks."""

"""Customer-journey inputs derived from the given tables, and the checks' SQL."""

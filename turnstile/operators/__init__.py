"""Table operators that the plans share: deduplication, lookups, statistics, regression."""

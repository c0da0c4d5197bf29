"""Daily-report data marts on Spark: incremental loading, as-of state, allocation."""

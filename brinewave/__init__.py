"""Field-survey and ocean time-series analytics expressed as Spark DataFrame transforms."""

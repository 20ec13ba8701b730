"""Social-graph queries and vector clustering as plain Spark DataFrame jobs."""

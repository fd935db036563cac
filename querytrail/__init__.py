"""Query-history and column-lineage analytics as plain Spark DataFrame jobs."""

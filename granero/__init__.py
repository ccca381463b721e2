"""Product, coverage and broker mart as Spark DataFrame jobs."""

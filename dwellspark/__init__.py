"""Stage-duration analytics as Spark DataFrame jobs."""

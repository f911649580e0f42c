"""Chat-archive analytics as Spark DataFrame jobs."""

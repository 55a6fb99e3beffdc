"""Daily market analytics as Spark DataFrame jobs."""

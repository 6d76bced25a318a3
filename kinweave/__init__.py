"""Identity resolution and relationship analytics as Spark DataFrame jobs."""

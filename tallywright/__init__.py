"""Entity rating and profile analytics as Spark jobs."""

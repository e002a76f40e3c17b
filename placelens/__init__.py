"""placelens: gazetteer analytics as Spark DataFrame jobs."""

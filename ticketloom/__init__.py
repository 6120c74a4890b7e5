"""Issue records to training tables, written as Spark jobs."""

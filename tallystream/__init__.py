"""Table and stream analytics written as Spark jobs."""

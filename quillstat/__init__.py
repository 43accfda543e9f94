"""Statistical analytics over labelled feature tables, written as Spark jobs."""

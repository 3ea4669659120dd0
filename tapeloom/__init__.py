"""Trade-tape analytics as Spark DataFrame and Structured Streaming jobs."""

"""Article recommendation from click logs, written as Spark DataFrame jobs."""

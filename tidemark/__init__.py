"""Keep entity tables in step with daily snapshot dumps, as Spark DataFrame jobs."""

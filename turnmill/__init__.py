"""Chat logs to clean training records, as Spark DataFrame transformations."""

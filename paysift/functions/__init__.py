"""Column expressions: each takes and returns Spark Columns."""

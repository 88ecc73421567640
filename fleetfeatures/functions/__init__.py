"""Column expressions: row-local, native Spark, no Python UDFs."""

"""Column expressions built from Spark's built-in functions."""

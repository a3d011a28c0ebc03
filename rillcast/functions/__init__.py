"""Column expressions built from Spark built-ins."""

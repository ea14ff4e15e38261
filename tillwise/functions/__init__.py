"""Column expressions whose meaning differs from the plain Spark built-in."""

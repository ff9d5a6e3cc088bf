"""Column expressions; each one is a composition of built-in Spark functions."""

"""Column expressions built only from Spark functions."""

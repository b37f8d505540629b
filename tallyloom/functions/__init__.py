"""Column expressions; every function takes and returns plain Columns."""

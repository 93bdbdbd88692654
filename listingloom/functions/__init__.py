"""Column expressions: each takes columns and returns one column."""

"""Column expressions: no DataFrame, no Python UDF."""

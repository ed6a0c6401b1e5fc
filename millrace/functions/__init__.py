"""Column expressions and vectorised UDFs."""

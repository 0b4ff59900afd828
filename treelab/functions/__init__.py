"""Column expressions and distributed ranking helpers shared by the operators."""

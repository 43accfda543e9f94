"""Column expressions and small table helpers shared by the operators."""

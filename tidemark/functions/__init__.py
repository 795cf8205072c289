"""Column expressions and small aggregate helpers shared by the operators."""

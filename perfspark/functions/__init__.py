"""Column expressions used inside the operators."""

"""Column expressions and exact distributed aggregates shared by the operators."""

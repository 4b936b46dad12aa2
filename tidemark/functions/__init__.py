"""Column expressions and small relational primitives shared by the operators."""

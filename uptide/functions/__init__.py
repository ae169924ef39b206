"""Column expressions and scale-safe building blocks shared by the operators."""

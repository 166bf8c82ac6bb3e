"""Column expressions: text, vectors and score arrays."""

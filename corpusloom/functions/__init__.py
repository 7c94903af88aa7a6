"""Column-expression building blocks (row-local; no shuffles)."""

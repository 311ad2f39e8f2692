"""Column expressions: metric formulas, padding, multi-hot genres, portable hashing."""

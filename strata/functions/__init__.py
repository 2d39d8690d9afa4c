"""Column expressions: name handling, casts, year, banding and scores."""

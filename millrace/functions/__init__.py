"""Column expressions: text, names, casts and calendar attributes."""

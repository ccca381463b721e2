"""Column expressions: numbers, texts and keys."""

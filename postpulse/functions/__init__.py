"""Column expressions: text, references, time and numbers."""

"""Column expressions: coercion, page text extraction, labels, display text."""

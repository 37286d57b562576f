"""Column functions: text, trigrams, JSON properties, filters, vectors."""

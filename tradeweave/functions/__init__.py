"""Column expressions: text, numbers, codes, hashes and predicates."""

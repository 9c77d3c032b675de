"""Column functions: hashing, text, numbers, dates."""

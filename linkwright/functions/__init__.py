"""Column functions: normalization, keys, phonetics and string similarity."""

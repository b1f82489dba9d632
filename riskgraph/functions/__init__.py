"""Column expressions (scalar functions, patterns, fixed codes)."""

"""Column expressions: coercion of raw values, risk rules, rounding."""

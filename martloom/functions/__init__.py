"""Column expressions: dates, text keys, exact rounding."""

"""Column expressions with fixed null, NaN and rounding rules."""

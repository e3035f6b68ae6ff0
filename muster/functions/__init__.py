"""Column expressions: cleaning, parsing, rounding and attendance flags."""

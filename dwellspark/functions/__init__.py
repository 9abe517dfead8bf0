"""Column expressions: cleaning, dates, durations, safe output values."""

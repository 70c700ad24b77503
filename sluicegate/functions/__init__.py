"""Column expressions: times, exact percentages and report texts."""

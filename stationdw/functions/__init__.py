"""Column expressions: numeric and date conversions, units, seasons, JSON fields."""

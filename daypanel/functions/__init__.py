"""Column expressions: calendar, numbers, text."""

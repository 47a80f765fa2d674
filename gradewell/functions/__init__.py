"""Column expressions: text, dates, numbers, flags and scores."""

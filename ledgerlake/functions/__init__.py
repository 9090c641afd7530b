"""Column expressions: text, numbers, dates, borrower JSON, loan arithmetic."""

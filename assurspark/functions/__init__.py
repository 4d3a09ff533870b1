"""Column expressions of the reports (filters, date windows, codes, names)."""

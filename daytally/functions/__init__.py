"""Column expressions for days, text and numbers."""

"""Column and aggregate expressions."""

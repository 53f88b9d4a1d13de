"""Column jobs: every function maps columns to a column with built-in expressions only."""

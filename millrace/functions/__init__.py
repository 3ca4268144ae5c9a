"""Column functions: text, arrays and metrics."""

"""Column functions: time, text and JSON."""

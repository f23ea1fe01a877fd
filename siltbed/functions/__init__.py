"""Column functions and join helpers."""

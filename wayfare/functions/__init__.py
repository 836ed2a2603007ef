"""Column functions: casts, time, geography, keys and text."""

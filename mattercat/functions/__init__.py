"""Column functions: lists kept as text, hashes, units, structures and names."""

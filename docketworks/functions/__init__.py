"""Column functions: rules, exact arithmetic, stable hashes."""

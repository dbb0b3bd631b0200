"""Column expressions of the domain: built-in functions only, no UDFs."""

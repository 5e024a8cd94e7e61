"""Column expressions: Column in, Column out, no Python UDFs."""

"""Column functions: built-in Spark expressions only (codegen, no Python per row)."""

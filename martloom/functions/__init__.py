"""Column expressions; every one is a built-in Spark expression, so plans stay in generated code."""

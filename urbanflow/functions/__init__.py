"""Column expressions; all run inside Spark's generated code."""

"""Column-expression helpers (built-in Spark SQL functions only)."""

"""Column functions (F-01..F-20): built-in Spark expressions only."""

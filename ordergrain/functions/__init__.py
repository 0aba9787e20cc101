"""Column helpers: every function takes and returns native Spark columns."""

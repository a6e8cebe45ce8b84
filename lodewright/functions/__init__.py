"""Column helpers: plain expressions that stay inside Spark's own execution."""

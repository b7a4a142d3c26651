"""Column expressions. All are built-in Spark expressions; none calls Python per row."""

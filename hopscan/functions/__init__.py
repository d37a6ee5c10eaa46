"""Column -> Column helpers, all built from Spark SQL functions."""

"""Column -> Column functions built from Spark's own expressions."""

"""Column functions: each takes Columns and returns a Column, all built in to Spark."""

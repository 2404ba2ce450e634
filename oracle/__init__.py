"""SQL that computes the same results without Spark, from flat columns only."""

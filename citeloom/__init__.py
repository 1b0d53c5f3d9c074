"""Citation analytics on Spark."""

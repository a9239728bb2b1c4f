"""Recovery analytics on Spark."""

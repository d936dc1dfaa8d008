"""gripe: complaint analytics on Spark."""

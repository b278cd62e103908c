"""Operational-table analytics on Spark: clean, model as a star, profile, train, score."""

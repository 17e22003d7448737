"""Rater-and-forecast analytics on Spark."""

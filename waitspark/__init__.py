"""Rider wait-time analytics on Spark: every step is a function from DataFrame to DataFrame."""

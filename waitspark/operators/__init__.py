"""Cleaning, joins, statistics and learning on DataFrames."""

"""Operators on DataFrames, grouped by kind of work."""

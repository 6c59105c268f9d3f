"""Operators: each takes keyed DataFrames and returns a DataFrame."""

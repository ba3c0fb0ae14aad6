"""Operators: every function takes DataFrames and returns a DataFrame; nothing is collected."""

"""Operators: each takes DataFrames and column names and gives back a lazy DataFrame."""

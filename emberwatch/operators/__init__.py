"""Operators: DataFrames in, DataFrames out, lazy, with every parameter explicit."""

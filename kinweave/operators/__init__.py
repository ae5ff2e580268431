"""Operators from DataFrames to DataFrames, all lazy."""

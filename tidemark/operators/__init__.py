"""Lazy DataFrame operators. Each takes DataFrames and parameters and returns DataFrames."""

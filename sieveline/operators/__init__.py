"""Operators over feed DataFrames."""

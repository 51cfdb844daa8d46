"""Displacement analytics for infrastructure, on Spark DataFrames."""

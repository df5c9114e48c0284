"""Joins, merges, windows and rollups on DataFrames."""

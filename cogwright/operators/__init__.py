"""Joins, merges, gates and serving operators over DataFrames."""

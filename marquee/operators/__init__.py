"""Joins, generators, aggregations and rankings on DataFrames."""

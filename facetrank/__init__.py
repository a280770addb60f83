"""Weighted facet ranking on Spark DataFrames."""

"""Delimited text, landed responses and stored tables as DataFrames."""

from facetrank.sources.delimited import read_delimited
from facetrank.sources.responses import countries_from_responses, country_values
from facetrank.sources.titles import load_titles, open_titles, read_titles

__all__ = [
    "countries_from_responses",
    "country_values",
    "load_titles",
    "open_titles",
    "read_delimited",
    "read_titles",
]

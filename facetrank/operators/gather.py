"""Aggregates that gather values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_max(df: DataFrame, by: Sequence[str], value: str, name: str | None = None) -> DataFrame:
    """Largest value per group; partial maxima are taken before the shuffle."""
    return df.groupBy(*by).agg(F.max(value).alias(name or value))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column; NULL counts as one value."""
    return df.select(column).distinct()


def collect_sorted(df: DataFrame, by: Sequence[str], column: str, name: str) -> DataFrame:
    """Array of the non-NULL values per group, duplicates kept, sorted.

    The array is one cell of the result, so apply it to ranked winners, not to
    raw rows.
    """
    return df.groupBy(*by).agg(F.sort_array(F.collect_list(column)).alias(name))

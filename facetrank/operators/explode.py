"""Array generators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetrank.functions.cells import tokenize
from facetrank.operators.filters import without_values
from facetrank.schemas import ITEM_SEP


def explode_facets(
    df: DataFrame,
    facets: dict[str, str],
    exclude: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One row per combination of the items of several arrays of a row.

    ``facets`` maps array column to item name; a row with a NULL or empty array
    yields nothing. Values in ``exclude`` (item name to values) are dropped
    right after their own explode, before the next one multiplies them.
    """
    for array, item in facets.items():
        rest = [c for c in df.columns if c != array]
        df = df.select(*rest, F.explode(array).alias(item))
        if exclude and item in exclude:
            df = without_values(df, item, exclude[item])
    return df


def deal(df: DataFrame, key: Column) -> DataFrame:
    """The same rows, those of one ``key`` side by side, in tasks of about equal bytes.

    For sums over combinations of several facets, of which one has many items: what
    is dealt by it before the other facets multiply it combines in its task, so partial
    sums stay near the number of groups. Adaptive execution sizes the tasks by what
    was shuffled, and splits a key that would fill more than one. So rows are dealt by
    a hash: sums by the key itself would do without a shuffle of their own, and that
    would keep a key whole.
    """
    return df.withColumn("_dealt", F.xxhash64(key)).hint("rebalance", F.col("_dealt")).drop("_dealt")


def tokenize_facets(df: DataFrame, facets: dict[str, str], sep: str = ITEM_SEP) -> DataFrame:
    """Like :func:`explode_facets` for delimited text; empty tokens are dropped."""
    for text in facets:
        df = df.withColumn(text, tokenize(text, sep))
    return explode_facets(df, facets)

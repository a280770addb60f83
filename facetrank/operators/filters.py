"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of the columns is NULL."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def keep_filled(df: DataFrame, array: str) -> DataFrame:
    """Rows whose array has at least one item; a NULL array fails as well."""
    return df.where(F.size(array) > 0)


def without_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is none of ``values``; NULL compares to nothing and goes too."""
    return df.where(~F.col(column).isin(*values))

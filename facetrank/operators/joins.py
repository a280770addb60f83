"""Equi-joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def star_join(
    fact: DataFrame, *others: DataFrame, key: str, how: str = "inner", strategy: str | None = None
) -> DataFrame:
    """Joins of all tables on one key.

    Every join clusters on the same key, so each table is shuffled at most
    once, and not at all if it is bucketed by the key. ``strategy`` is a join
    hint; by default Catalyst chooses, and broadcasts a table only below its
    size limit.
    """

    def hinted(table: DataFrame) -> DataFrame:
        return table.hint(strategy) if strategy else table

    return reduce(lambda left, right: left.join(hinted(right), key, how), others, fact)


def look_up(
    df: DataFrame,
    dim: DataFrame,
    on: tuple[str, str],
    take: dict[str, str],
    how: str = "inner",
    read_twice: bool = False,
) -> DataFrame:
    """Add columns of a dimension whose key has another name.

    ``on`` is (column of df, column of dim); ``take`` maps dimension columns to
    result names. An inner join leaves out NULL keys as early as the plan allows.
    Where ``df`` itself comes from rows that are ``read_twice``, that would make two
    readings of them; then NULL keys, which should be few, go on to the join.
    """
    left_key, right_key = on
    found = dim.select(
        F.col(right_key).alias("_found"), *[F.col(c).alias(name) for c, name in take.items()]
    )
    same = F.col(left_key) == F.col("_found")
    if read_twice:
        found = found.where(F.col("_found").isNotNull())
        same = F.col(left_key).eqNullSafe(F.col("_found"))
    return df.join(found, same, how).drop("_found")


def new_rows(df: DataFrame, known: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not among ``known``; NULL keys equal each other."""
    own = known.select(*[F.col(k).alias(f"_known_{k}") for k in key]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in key]
    return df.join(own, same, "left_anti")

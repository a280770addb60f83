"""Ranks, winners and top-k per group.

A group may hold most of all rows, so nothing here needs a whole group, or all
rows tied for a place, in one task. Winners come from partial maxima and a join;
full ranks from value ranges that are ranked apart; a row number compared with a
constant keeps only the best rows of each task before the shuffle
(WindowGroupLimit).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from facetrank.operators.gather import group_max

ROWS_PER_RANGE = 1_000_000
# Narrow ranges per wide one. A group of 10**12 values has about as many wide ranges.
FAN_OUT = 1_000


def _same(left: Sequence[str], right: Sequence[str]) -> list[Column]:
    """Null-safe equality of columns, pair by pair."""
    return [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)]


def rank_within(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    name: str = "ranking",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """RANK per group by ``value`` descending: ties share a rank, gaps follow, NULLs are last."""
    ranked = _ranked(df, by, value, rows_per_range)
    return ranked.select(*df.columns, F.col("_rank").cast("int").alias(name))


def rerank_dense(
    df: DataFrame,
    by: Sequence[str],
    rank: str,
    name: str = "ranking",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """DENSE_RANK per group by a number ascending: closes the gaps left by an earlier rank."""
    ranked = _ranked(df.withColumn("_down", -F.col(rank)), by, "_down", rows_per_range)
    return ranked.select(*df.columns, F.col("_dense").cast("int").alias(name))


def top_ties(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """All rows tied for the largest value of their group.

    A group whose values are all NULL keeps all its rows, as a rank would. The
    maxima are one row per group; rows are joined on group and value, so tied
    rows can be split between tasks.
    """
    best = [f"_{c}" for c in [*by, value]]
    maxima = group_max(df, by, value).toDF(*best)
    return df.join(maxima, _same([*by, value], best), "left_semi")


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """Exactly min(k, size) rows per group; ``order`` should end in a tie-break."""
    row = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return df.withColumn("_row", row).where(F.col("_row") <= k).drop("_row")


def one_row_per_key(df: DataFrame, key: Sequence[str], prefer: Sequence[Column]) -> DataFrame:
    """The preferred row of each key, for tables that were appended to."""
    return top_k(df, key, prefer, 1)


def argmax_ties(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """All rows that hold the maximum of their group.

    The join key includes the value, so rows of one large group are spread by
    value; the maxima are one row per group.
    """
    best = group_max(df, by, value)
    return df.join(best, [*by, value], "left_semi").select(*df.columns)


def rank_large_groups(
    df: DataFrame, by: Sequence[str], value: str, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """RANK and DENSE_RANK by ``value`` descending, without a task per group.

    Rows shrink to one per distinct (group, value) with a count. Values whose hash
    is a multiple of ``rows_per_range`` cut a group into ranges of about that many
    values; a range is ranked by itself and shifted by the number of rows in
    higher ranges. The cuts follow from the values alone, so a task that is run
    again cuts in the same places. The result is exact for any cuts. NULLs rank
    last. ``value`` is a number.
    """
    names = {"_rank": "ranking", "_dense": "dense_ranking"}
    return _ranked(df, by, value, rows_per_range).withColumnsRenamed(names)


def _above(cuts: Column, value: Column) -> Column:
    """How many of the ascending ``cuts`` are greater than ``value``, by halving."""
    steps = F.ceil(F.log2(F.size(cuts) + F.lit(1.0))).cast("int")

    def halve(state: Column, _: Column) -> Column:
        middle = F.shiftright(state["low"] + state["high"], 1)
        on = F.get(cuts, middle) <= value
        open_ = state["low"] < state["high"]
        return F.struct(
            F.when(open_ & on, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(open_ & ~on, middle).otherwise(state["high"]).alias("high"),
        )

    start = F.struct(F.lit(0).alias("low"), F.size(cuts).alias("high"))
    found = F.aggregate(F.sequence(F.lit(1), steps), start, halve, lambda state: state["low"])
    return F.size(cuts) - found


def _cut(values: DataFrame, keys: list[str], name: str, every: int) -> DataFrame:
    """Adds the number of the range a value falls into, from the highest down.

    Ranges are those between the values of the same ``keys`` whose hash is a multiple
    of ``every``. Cuts join as one sorted array per key, which only this step holds.
    """
    # -0.0 and 0.0 are one value and must have one hash.
    chosen = F.pmod(F.xxhash64(F.col("_value") + F.lit(0)), F.lit(every)) == 0
    cut_keys = [f"_cut{k}" for k in keys]
    cuts = (
        values.where(F.col("_value").isNotNull() & chosen)
        .groupBy(*[F.col(k).alias(c) for k, c in zip(keys, cut_keys, strict=True)])
        .agg(F.sort_array(F.collect_list("_value")).alias("_cuts"))
    )
    above = F.when(F.col("_cuts").isNotNull(), _above(F.col("_cuts"), F.col("_value")))
    return values.join(cuts, _same(keys, cut_keys), "left").select(
        *values.columns, F.coalesce(above, F.lit(0)).cast("bigint").alias(name)
    )


def _ranked(df: DataFrame, by: Sequence[str], value: str, rows_per_range: int) -> DataFrame:
    keys = [f"_{c}" for c in by]
    values = (
        df.groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            *[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)],
            F.col(value).alias("_value"),
            "_rows",
        )
    )
    # Few cuts part a group into wide ranges; the cuts within a wide range part it
    # again. So no value looks through more than about FAN_OUT cuts, by halving.
    wide = _cut(values, keys, "_wide", rows_per_range * FAN_OUT)
    narrow = _cut(wide, [*keys, "_wide"], "_narrow", rows_per_range)
    none = F.lit(None).cast("struct<_wide:bigint,_narrow:bigint>")
    placed = narrow.select(
        *keys,
        "_value",
        "_rows",
        F.when(F.col("_value").isNull(), none).otherwise(F.struct("_wide", "_narrow")).alias("_range"),
    )
    # A row per range.
    before = (
        W.partitionBy(*keys).orderBy(F.asc_nulls_last("_range")).rowsBetween(W.unboundedPreceding, -1)
    )
    shift_keys = [f"_shift{k}" for k in [*keys, "_range"]]
    shifts = (
        placed.groupBy(*keys, "_range")
        .agg(F.sum("_rows").alias("_n"), F.count(F.lit(1)).alias("_distinct"))
        .select(
            *[F.col(k).alias(s) for k, s in zip([*keys, "_range"], shift_keys, strict=True)],
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows_above"),
            F.coalesce(F.sum("_distinct").over(before), F.lit(0)).alias("_values_above"),
        )
    )
    inside = W.partitionBy(*keys, "_range").orderBy(F.desc("_value"))
    earlier = inside.rowsBetween(W.unboundedPreceding, -1)
    ranks = placed.join(shifts, _same([*keys, "_range"], shift_keys)).select(
        *keys,
        "_value",
        (F.col("_rows_above") + F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) + 1).alias("_rank"),
        (F.col("_values_above") + F.row_number().over(inside)).alias("_dense"),
    )
    return df.join(ranks, _same([*by, value], [*keys, "_value"])).drop(*keys, "_value")

"""Connected components by alternating large-star and small-star steps.

Each step joins edges with the smallest neighbour of one end. Both sides of the
join are written tables, so a node with very many neighbours is split by adaptive
execution. Nothing but a count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetrank.llm.common import stored

EDGES_PER_TASK = 100_000


def _mark(edges: DataFrame):
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def _linked(pairs: DataFrame, only_higher: bool, tasks: int) -> DataFrame:
    """Ties ends of ``(node, near)`` to the smallest end near ``node``."""
    least = stored(
        pairs.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("least")).coalesce(tasks),
        "least_ends",
    )
    joined = pairs.join(least, "node")
    if only_higher:  # large star: far ends move to the smallest
        linked = joined.where("near > node").select(F.col("near").alias("high"), F.col("least").alias("low"))
    else:  # small star: the node and its smaller ends move
        linked = joined.select(F.col("near").alias("high"), F.col("least").alias("low")).union(
            least.select(F.col("node").alias("high"), F.col("least").alias("low"))
        )
    return stored(linked.where("high != low").distinct().coalesce(tasks), "edges")


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every end of ``edges (a, b)``; the label is the smallest end.

    Ends are of any ordered type. Repeated edges, both directions and loops are
    fine; an end that has only loops is not listed.
    """
    current = stored(
        edges.where("a != b")
        .select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
        .distinct(),
        "edges",
    )
    mark = _mark(current)
    while mark[0]:
        # Few edges, few files: rounds end with few, however many partitions a shuffle has.
        tasks = 1 + mark[0] // EDGES_PER_TASK
        both = stored(
            current.select(F.col("high").alias("node"), F.col("low").alias("near")).union(
                current.select(F.col("low").alias("node"), F.col("high").alias("near"))
            ).coalesce(tasks),
            "both_ways",
        )
        large = _linked(both, True, tasks)
        down = large.select(F.col("high").alias("node"), F.col("low").alias("near"))
        current = _linked(down, False, tasks)
        after = _mark(current)
        if after == mark:
            break
        mark = after
    return current.select(F.col("high").alias("node"), F.col("low").alias("label")).union(
        current.select(F.col("low").alias("node"), F.col("low").alias("label")).distinct()
    )

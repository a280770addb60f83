"""Long ordered groups, without a task per group: places in order, and digests.

Rows are dealt out by ranges of (group, order), so that a group holding a third of
all rows lies in many tasks. Each task numbers its own rows; a group that goes on
from one task to the next is shifted by the rows before, of which there is a count
per task.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from facetrank.llm.common import in_arrow, stored


def crc32_of(text: Column) -> Column:
    return F.crc32(text.cast("binary"))


def _number(batches):
    """Adds the task's number and the place among the group's rows of this task."""
    task = TaskContext.get().partitionId()
    group, place = object(), 0
    for batch in batches:
        places = []
        for value in batch.column(0).to_pylist():
            group, place = value, place + 1 if value == group else 1
            places.append(place)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([task] * batch.num_rows, pa.int32()), pa.array(places, pa.int64())],
            [*batch.schema.names, "_task", "_own"],
        )


def numbered(df: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """``df`` stored, with a ``place`` from 1 within each ``group`` in ``order``.

    Null is a group. Rows that are equal in group and order are numbered in any
    order, so the order should name rows. ``group`` becomes the first column.
    """
    df = df.select(group, *[c for c in df.columns if c != group])
    dealt = df.repartitionByRange(F.col(group).asc_nulls_first(), *order).sortWithinPartitions(
        F.col(group).asc_nulls_first(), *order
    )
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    rows = stored(in_arrow(dealt, _number, f"{fields}, _task int, _own bigint"), name)
    spans = rows.groupBy(F.col(group).alias("_group"), F.col("_task").alias("_at")).agg(
        F.max("_own").alias("_rows")
    )
    before = W.partitionBy("_group").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    shifts = stored(spans.withColumn("_shift", F.sum("_rows").over(before)).where("_shift > 0"), "shifts")
    # At most one row per task: only its first group can have begun before.
    placed = rows.join(
        F.broadcast(shifts),
        F.col(group).eqNullSafe(F.col("_group")) & (F.col("_task") == F.col("_at")),
        "left",
    )
    return placed.select(*df.columns, (F.col("_own") + F.coalesce("_shift", F.lit(0))).alias("place"))


def _digester(keys: int, separator: bytes):
    def run(batches):
        current, digest = None, None
        for batch in batches:
            names = batch.schema.names[:keys]
            done, sums = [], []
            for *key, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if digest is None or key != current:
                    if digest is not None:
                        done.append(current)
                        sums.append(digest.hexdigest())
                    current, digest = key, hashlib.sha256(piece)
                else:
                    digest.update(separator + piece)
            if done:
                yield _sums(done, sums, names, batch)
        if digest is not None:
            yield _sums([current], [digest.hexdigest()], names, batch)

    def _sums(done, sums, names, batch):
        columns = [
            pa.array(values, batch.schema.field(name).type)
            for name, values in zip(names, zip(*done, strict=True), strict=True)
        ]
        return pa.RecordBatch.from_arrays([*columns, pa.array(sums)], [*names, "sha256"])

    return run


def joined_sha256(
    df: DataFrame, keys: list[str], order: list[Column], piece: Column, separator: bytes
) -> DataFrame:
    """``keys`` and the lowercase ``sha256`` of each group's pieces in order, joined.

    A digest of joined bytes can only be taken in order, so a group's pieces pass
    through one task; they are streamed, and never held together.
    """
    pieces = df.select(*keys, *[o_ for o_ in ()])
    dealt = df.repartition(*keys).sortWithinPartitions(
        *[F.col(k).asc_nulls_first() for k in keys], *order
    )
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    pieces = dealt.select(*keys, F.coalesce(piece, F.lit("")).cast("binary").alias("piece"))
    return in_arrow(pieces, _digester(len(keys), separator), f"{kinds}, sha256 string")

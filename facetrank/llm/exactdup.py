"""Exact deduplication by deterministic block naming.

A normalised text is cut into blocks of ``BLOCK`` bytes. Equal blocks get one
integer name: the blocks are dealt out by value, sorted, and numbered in that
order. Adjacent names are then paired and the pairs sorted and numbered in the
same way, until each document is one name. Names stand for equal content and
never for a hash, so two documents share an identity exactly if they are equal.

Only the first naming moves text. Equal blocks of a batch travel as one row with
the places they come from, so a block that a third of the corpus shares arrives
as one row per batch. Later levels move three integers per pair; each has half
the rows of the one before.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetrank.llm.common import in_arrow, shuffle_partitions, stored

BLOCK = 1024

_OCCURRENCE = "struct<row:bigint,pos:int,total:int,doc_id:bigint,sha:binary>"
_OCCURRENCE_ARROW = pa.struct(
    [
        ("row", pa.int64()),
        ("pos", pa.int32()),
        ("total", pa.int32()),
        ("doc_id", pa.int64()),
        ("sha", pa.binary()),
    ]
)
_BATCH_BYTES = 8 << 20


def _lists(per_key: list[list[tuple]], kind: pa.DataType) -> pa.ListArray:
    offsets, flat = [0], []
    for rows in per_key:
        flat.extend(rows)
        offsets.append(len(flat))
    columns = zip(*flat, strict=True) if flat else [[] for _ in kind]
    fields = [pa.array(c, kind.field(i).type) for i, c in enumerate(columns)]
    struct = pa.StructArray.from_arrays(fields, fields=list(kind))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct)


def _cut(batches):
    """Documents to distinct blocks of a batch, each with all its places."""
    base = TaskContext.get().partitionId() << 33
    row = 0

    def flush(found):
        return pa.RecordBatch.from_arrays(
            [pa.array(found, pa.binary()), _lists(list(found.values()), _OCCURRENCE_ARROW)],
            ["block", "places"],
        )

    for batch in batches:
        found: dict[bytes, list[tuple]] = {}
        held = 0
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            text = text.lower()  # of bytes: A-Z only
            total = max(1, -(-len(text) // BLOCK))
            sha = hashlib.sha256(text).digest()
            for pos in range(total):
                block = text[pos * BLOCK : (pos + 1) * BLOCK]
                place = (base + row, pos, total, doc_id if pos == 0 else None, sha if pos == 0 else None)
                found.setdefault(block, []).append(place)
                if len(found) * BLOCK >= _BATCH_BYTES:
                    yield flush(found)
                    found = {}
            row += 1
        if found:
            yield flush(found)


def _number_blocks(batches):
    """Sorted blocks to integers; only the last block is held."""
    name = TaskContext.get().partitionId() << 33
    last = None
    for batch in batches:
        names = []
        for block in batch.column(0).to_pylist():
            if last is not None and block != last:
                name += 1
            last = block
            names.append(name)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), batch.column(1)], ["name", "places"]
        )


def identities(docs: DataFrame) -> DataFrame:
    """``(row, level, name, doc_id, sha)``: equal texts have equal (level, name)."""
    spark = docs.sparkSession
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    parts = shuffle_partitions(spark)
    blocks = in_arrow(source, _cut, f"block binary, places array<{_OCCURRENCE}>")
    named = in_arrow(
        blocks.repartition(parts, "block").sortWithinPartitions("block"),
        _number_blocks,
        f"name bigint, places array<{_OCCURRENCE}>",
    ).select("name", F.inline("places"))
    level0 = stored(named, "block_names")
    heads = level0.where(F.col("pos") == 0).select("row", "doc_id", "sha")
    longest = level0.agg(F.max("total")).first()[0] or 0
    current, done, level = level0.select("row", "pos", "total", "name"), [], 0
    while True:
        done.append(current.where("total = 1").select("row", F.lit(level).alias("level"), "name"))
        if longest <= 1:
            break
        half = F.floor(F.col("pos") / 2).cast("int")
        even = F.col("pos") % 2 == 0
        pairs = stored(
            current.where("total > 1")
            .groupBy("row", half.alias("pos"), F.ceil(F.col("total") / 2).cast("int").alias("total"))
            .agg(
                F.max(F.when(even, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"),
            ),
            "block_pairs",
        )
        names = stored(
            pairs.select("a", "b")
            .distinct()
            .repartition(parts, "a", "b")
            .sortWithinPartitions("a", "b")
            .select("a", "b", F.monotonically_increasing_id().alias("name")),
            "pair_names",
        )
        # Both sides are plain scans, so a pair that very many documents share
        # is split by adaptive execution.
        current = pairs.join(names, ["a", "b"]).select("row", "pos", "total", "name")
        longest = -(-longest // 2)
        level += 1
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    return every.join(heads, "row")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: which row of its group of equal texts stays.

    Texts are equal when identical after lowering A-Z. The row with the largest
    doc_id stays: ``keep_id``; ``group_size`` counts rows. Null text is empty
    text and equals it. A null doc_id is smaller than any other; a group of only
    null ids keeps all its rows (``keep_id`` null). Rows that repeat the doc_id
    that stays are all kept. An empty table gives no rows; other columns are
    ignored.
    """
    every = stored(identities(docs), "identities")
    groups = stored(
        every.groupBy("level", "name").agg(
            F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
        ),
        "identity_groups",
    )
    return every.join(groups, ["level", "name"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )

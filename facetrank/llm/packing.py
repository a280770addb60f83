"""Packing by minimum bin slack over a histogram of lengths.

Documents are cut into pieces of the window's capacity and one rest. What has to be
packed is then a multiset of lengths, and there are only as many lengths as the
capacity: the plan is made from their counts, whatever the number of documents.

The plan takes the longest length left and asks which multiset of the lengths left
fills its window closest to capacity. A bitset (bit n: a sum of n can be reached) is
shifted by each length, in powers of two of its count; the first bit at capacity
ends the search, and walking back through the bitsets gives how often each length
is used. The pattern is repeated as often as the counts allow, so every pattern uses
up a length or nearly so. Where no choice fills the window, the slack is cut from the
longest piece left, whose rest is a length like any other. So all windows are full
but the last, which may be padded.

Each piece is then placed by the number it has among the pieces of its length.
"""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from facetrank.llm.common import in_arrow, stored
from facetrank.llm.tokenfile import worker_encoder

CAPACITY = 4096
END_ID = 2
_DOCS_AT_ONCE = 128
# Words whose ids a worker remembers; more only spare time.
WORDS_KEPT = 400_000
# So many parts, of some 100 bytes each, are broadcast.
FEW_CUTS = 50_000


class Pattern(NamedTuple):
    """A filled window: ``uses`` pieces of each length, ``times`` windows like this.

    With ``cut`` the window ends with that many ids of a piece of length ``cut_from``.
    """

    uses: dict[int, int]
    times: int
    cut_from: int = 0
    cut: int = 0


def padding(total: int, capacity: int = CAPACITY) -> int:
    """Padding of a window; one at a power of two is not padded."""
    return 0 if total & (total - 1) == 0 else capacity - total


def _fill(first: int, counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset with ``first`` in it that leaves the least padding.

    Ties go to the fuller window. ``counts`` are what may be added to ``first``.
    """
    room = capacity - first
    mask = (1 << (room + 1)) - 1
    reached = [1]
    steps: list[tuple[int, int]] = []
    for length in sorted(counts, reverse=True):
        left = min(counts[length], room // length)
        bundle = 1
        while left > 0 and not reached[-1] >> room & 1:
            used = min(bundle, left)
            steps.append((length, used))
            reached.append((reached[-1] | reached[-1] << (length * used)) & mask)
            left, bundle = left - used, bundle * 2
        if reached[-1] >> room & 1:
            break
    sums, best = reached[-1], None
    while sums:
        total = first + sums.bit_length() - 1
        if best is None or padding(total, capacity) < padding(best, capacity):
            best = total
        if padding(best, capacity) == 0:
            break
        sums &= (1 << (sums.bit_length() - 1)) - 1
    uses: dict[int, int] = defaultdict(int)
    rest = best - first
    for (length, used), before in zip(reversed(steps), reversed(reached[:-1]), strict=True):
        if not before >> rest & 1:  # this bundle is needed
            uses[length] += used
            rest -= length * used
    uses[first] += 1
    return dict(uses)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that use every counted length exactly as often as it occurs."""
    left = {length: n for length, n in counts.items() if n > 0}
    patterns = []
    while left:
        first = max(left)
        others = dict(left)
        others[first] -= 1
        uses = _fill(first, {k: n for k, n in others.items() if n}, capacity)
        slack = padding(sum(length * used for length, used in uses.items()), capacity)
        # Any piece that is left is longer than the slack: a shorter one would be used.
        spare = [k for k, n in left.items() if n > uses.get(k, 0)] if slack else []
        cut_from, cut = (max(spare), slack) if spare else (0, 0)
        needs = dict(uses)
        if cut:
            needs[cut_from] = needs.get(cut_from, 0) + 1
        times = min(left[length] // used for length, used in needs.items())
        patterns.append(Pattern(uses, times, cut_from, cut))
        for length, used in needs.items():
            left[length] -= used * times
            if not left[length]:
                del left[length]
        if cut:
            left[cut_from - cut] = left.get(cut_from - cut, 0) + times
    return patterns


_PIECES = (
    "doc_id bigint, start bigint, length int, doc_tokens bigint, ids binary, task int, nth bigint"
)


def _cutter(definition, capacity: int):
    """Pieces of each document, numbered among the task's pieces of their length."""

    def run(batches):
        task = TaskContext.get().partitionId()
        encoder = worker_encoder(definition.value)
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, _DOCS_AT_ONCE):
                part = batch.slice(at, _DOCS_AT_ONCE)
                rows = []
                encoder.keep_words(WORDS_KEPT)
                texts = encoder.encode(part.column(1).to_pylist())
                for doc_id, data in zip(part.column(0).to_pylist(), texts, strict=True):
                    ids = np.append(np.frombuffer(data, encoder.kind), END_ID).astype("<u4")
                    for start in range(0, len(ids), capacity):
                        own = ids[start : start + capacity]
                        rows.append((doc_id, start, len(own), len(ids), own.tobytes(), task, int(seen[len(own)])))
                        seen[len(own)] += 1
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    ["doc_id", "start", "length", "doc_tokens", "ids", "task", "nth"],
                )

    return run


class _Places(NamedTuple):
    """The plan, by length: numbers from ``first`` on go to windows from ``window`` on.

    With ``cut`` only so many ids do; the rests are numbered from ``tail`` on.
    """

    first: np.ndarray
    uses: np.ndarray
    window: np.ndarray
    offset: np.ndarray
    cut: np.ndarray
    tail: np.ndarray


def _places(patterns: list[Pattern], counts: dict[int, int]) -> dict[int, _Places]:
    rows, taken, window = defaultdict(list), defaultdict(int), 0
    known = defaultdict(int, counts)
    for pattern in patterns:
        offset = 0
        for length in sorted(pattern.uses, reverse=True):
            used = pattern.uses[length]
            rows[length].append((taken[length], used, window, offset, 0, 0))
            taken[length] += used * pattern.times
            offset += used * length
        if pattern.cut:
            length, rest = pattern.cut_from, pattern.cut_from - pattern.cut
            rows[length].append((taken[length], 1, window, offset, pattern.cut, known[rest]))
            taken[length] += pattern.times
            known[rest] += pattern.times
        window += pattern.times
    return {k: _Places(*np.array(v, np.int64).T) for k, v in rows.items()}


def _parts(places: dict[int, _Places], length: np.ndarray, number: np.ndarray) -> list[np.ndarray]:
    """Row, start in its piece, length, window and offset of every part."""
    row, start = np.arange(len(length)), np.zeros(len(length), np.int64)
    found = []
    while len(row):
        rests = []
        for kind in np.unique(length):
            at = np.flatnonzero(length == kind)
            own = places[int(kind)]
            segment = np.searchsorted(own.first, number[at], "right") - 1
            nth = number[at] - own.first[segment]
            cut = own.cut[segment]
            found.append(
                (
                    row[at],
                    start[at],
                    np.where(cut > 0, cut, kind),
                    own.window[segment] + nth // own.uses[segment],
                    own.offset[segment] + nth % own.uses[segment] * int(kind),
                )
            )
            on = cut > 0
            rests.append((row[at][on], (start[at] + cut)[on], (kind - cut)[on], (own.tail[segment] + nth)[on]))
        row, start, length, number = (np.concatenate(c) for c in zip(*rests, strict=True))
    return [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 5


def _placer(shared):
    def run(batches):
        for batch in batches:
            size = np.array(batch.column("size")).astype(np.int64)
            row, start, length, window, offset = _parts(shared.value, size, np.array(batch.column("number")))
            order = np.lexsort((start, row))
            columns = [batch.column(c).take(pa.array(row[order])) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays(
                [*columns, *(pa.array(x[order]) for x in (start, length, window, offset))],
                [*batch.schema.names, "within", "length", "sequence_id", "offset"],
            )

    return run


def pieces_of(docs: DataFrame, definition: str, capacity: int = CAPACITY) -> DataFrame:
    """Stored pieces ``(doc_id, start, length, doc_tokens, ids, task, nth)``.

    ``ids`` are little-endian unsigned 32-bit numbers.
    """
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    return stored(in_arrow(source, _cutter(shared, capacity), _PIECES), "pieces")


def place(pieces: DataFrame, columns: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Where each part of the ``pieces`` stands: a row per part.

    ``task``, ``nth`` and ``size`` name the piece; ``within`` and ``length`` are the
    part's place in it. Of the other columns only ``columns`` move. The driver sees
    the counts of lengths, at most ``capacity`` rows, and broadcasts the plan, which
    is made of them alone. Sequences are numbered from 0 without gaps.
    """
    per_task = pieces.groupBy("task", F.col("length").alias("size")).agg(F.count("*").alias("n"))
    # A row per task and length; a length of very many pieces has one row per task.
    before = W.partitionBy("size").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    counts = stored(
        per_task.select("task", "size", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")),
        "length_counts",
    )
    histogram = {r.size_: r.n for r in counts.groupBy(F.col("size").alias("size_")).agg(F.sum("n").alias("n")).collect()}
    places = _places(plan(histogram, capacity), histogram)
    shared = pieces.sparkSession.sparkContext.broadcast(places)
    light = pieces.select("task", "nth", F.col("length").alias("size"), *columns)
    numbered = light.join(counts.drop("n"), ["task", "size"]).select(
        "task", "nth", "size", *columns, (F.col("before") + F.col("nth")).alias("number")
    )
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema)
    return in_arrow(
        numbered, _placer(shared), f"{kinds}, within bigint, length bigint, sequence_id bigint, offset bigint"
    ).drop("number")


def pack(docs: DataFrame, definition: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of ``docs`` with its ids and its place in a sequence.

    ``(doc_id, start, length, doc_tokens, ids, sequence_id, offset)``. A text is
    encoded whole and ends with id 2; null and empty texts are the end id alone.
    Rows that repeat a doc_id, or have none, are packed like any other. An empty
    table gives no rows. Other columns are ignored.
    """
    pieces = pieces_of(docs, definition, capacity)
    placed = place(pieces, ["doc_id", "start", "doc_tokens", "ids"], capacity)
    return placed.select(
        "doc_id",
        (F.col("start") + F.col("within")).alias("start"),
        "length",
        "doc_tokens",
        _slice(F.col("ids")).alias("ids"),
        "sequence_id",
        "offset",
    )


def _slice(ids):
    return F.substring(ids, (4 * F.col("within") + 1).cast("int"), (4 * F.col("length")).cast("int"))


def pack_digests(docs: DataFrame, definition: str, capacity: int = CAPACITY) -> DataFrame:
    """As :func:`pack`, with a crc32 of the ids in their stead.

    Whole pieces are digested where they lie. The ids of pieces that are cut are
    fetched by a join; as long as ``FEW_CUTS`` pieces are cut, counted here, those go to
    the ids.
    """
    pieces = pieces_of(docs, definition, capacity).withColumn("ids_crc32", F.crc32("ids"))
    placed = stored(place(pieces, ["doc_id", "start", "doc_tokens", "ids_crc32"], capacity), "parts")
    whole = placed.where("length = size")
    held = pieces.select("task", "nth", F.col("length").alias("size"), "ids")
    parts = placed.where("length < size")
    if parts.limit(FEW_CUTS + 1).count() <= FEW_CUTS:
        parts = F.broadcast(parts)
    cut = held.join(parts, ["task", "nth", "size"])
    cut = cut.withColumn("ids_crc32", F.crc32(_slice(F.col("ids")))).select(*whole.columns)
    return whole.unionByName(cut).select(
        "doc_id",
        (F.col("start") + F.col("within")).alias("start"),
        "length",
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        "offset",
    )

"""Repair of conversation structure: cheapest edits by a parallel Viterbi search.

A conversation shall read ``(system? (user assistant)+)?``. Rows may be kept (0),
given the other role of user and assistant (2) or deleted (3); a user or assistant
row without text may be inserted (2). Blank rows and repeats have to go; a row that
breaks off costs 1 where it stays. What has been written so far is one of four
states, so the costs to the end are a vector of four numbers for each place.

Vectors run backward. A conversation is cut into chunks, and all chunks start at once
from a speculative vector at their end, that of a finished conversation. A fix-up
pass gives each chunk the vector found at the start of the next one and reruns those
where it differs by more than a constant; costs depend on the far end for a few
rows only, so the passes end soon (at the latest after as many as there are chunks).
With the stitched vectors each chunk is traced forward for the states it may start
in, and the states are chained in the same way. At each place the letter that sorts
first among the cheapest is taken: Delete, Insert, Keep, Rerole.

Rows that have to go leave the state as it is and are cheapest deleted at once, so
they are counted, not searched. Texts take no part; rows are known by digests.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from facetrank.llm.common import in_arrow, stored

CHUNK = 4096
DELETE, INSERT, REROLE, BROKEN = 3, 2, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
# From each state: where an inserted or re-roled row leads.
_FORWARD = (USER, USER, ASSISTANT, USER)
# From each state: where a kept row of initial s, u, a or another leads.
_KEPT = (
    (SYSTEM, None, None, None),
    (USER, USER, None, USER),
    (None, None, ASSISTANT, None),
    (None, None, None, None),
)
_ROLES = {USER: "user", ASSISTANT: "assistant"}
FINISHED = (0, 2 * INSERT, INSERT, 0)

_NOT_BLANK = r"[^\x20\x09-\x0D]"
_WHOLE = r"[.!?][\x20\x09-\x0D]*\z"


def _relative(costs: tuple) -> tuple:
    least = min(costs)
    return tuple(c - least for c in costs)


@lru_cache(maxsize=None)
def _back(code: int, after: tuple) -> tuple:
    """Costs before a row from those after it; ``code`` is initial * 2 + broken."""
    initial, broken = divmod(code, 2)
    costs = []
    for state in range(4):
        best = DELETE + after[state]
        if (kept := _KEPT[initial][state]) is not None:
            best = min(best, broken + after[kept])
        costs.append(min(best, REROLE + broken + after[_FORWARD[state]]))
    costs[USER], costs[ASSISTANT] = (
        min(costs[USER], INSERT + costs[ASSISTANT]),
        min(costs[ASSISTANT], INSERT + costs[USER]),
    )
    for state in (START, SYSTEM):
        costs[state] = min(costs[state], INSERT + costs[USER])
    return tuple(costs)


@lru_cache(maxsize=None)
def _edit(code: int, after: tuple, state: int) -> tuple:
    """Letters up to and with the row's own, their cost, the state and the row's new role."""
    before = _back(code, after)
    initial, broken = divmod(code, 2)
    letters, cost = "", 0
    while True:
        if DELETE + after[state] == before[state]:
            return letters + "D", cost + DELETE, state, None
        onward = _FORWARD[state]
        if INSERT + before[onward] == before[state]:
            letters, cost, state = letters + "I", cost + INSERT, onward
            continue
        kept = _KEPT[initial][state]
        if kept is not None and broken + after[kept] == before[state]:
            return letters + "K", cost + broken, kept, ""
        return letters + "R", cost + REROLE + broken, onward, _ROLES[onward]


def _vectors(codes: bytes, end: tuple) -> list[tuple]:
    """For each row the relative costs after it, and last those before all rows."""
    vectors = [end]
    for code in reversed(codes):
        vectors.append(_relative(_back(code, vectors[-1])))
    return vectors[::-1]


def initials(role: Column) -> Column:
    return F.substring(role, 1, 1)


def with_faults(rows: DataFrame) -> DataFrame:
    """Distinct rows without their texts, with what is wrong with them.

    ``(conv_id, turn, role, name, initial, copies, fault, first)``; ``name`` is a
    digest of role and text, ``first`` marks the earliest place of a name in its
    conversation. Equal rows are counted before they move.
    """
    text = F.col("text")
    name = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", text), 256))
    fault = (
        F.when(~text.rlike(_NOT_BLANK), "blank").when(~text.rlike(_WHOLE), "truncated").otherwise("")
    )
    light = rows.select(
        "conv_id", "turn", "role", name.alias("name"), fault.alias("fault"), F.col("copies")
    )
    light = stored(
        light.groupBy("conv_id", "turn", "role", "name", "fault").agg(F.sum("copies").alias("copies")),
        "rows_of_conversations",
    )
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    earliest = light.groupBy("conv_id", "name").agg(F.min(place).alias("_earliest"))
    keyed = earliest.select(F.col("conv_id").alias("_c"), F.col("name").alias("_n"), "_earliest")
    return light.join(
        keyed, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("name") == F.col("_n"))
    ).select(
        *light.columns,
        initials(F.col("role")).alias("initial"),
        F.col("_earliest").eqNullSafe(place).alias("first"),
    )


_CHUNKS = (
    "conv_id bigint, task int, nth int, opens string, closes string, illegal bigint, "
    "blank bigint, duplicate bigint, truncated bigint, "
    "codes binary, gone array<bigint>, turns array<bigint>, names array<binary>"
)


class _Chunk:
    def __init__(self, conv_id, task: int, nth: int):
        self.key = (conv_id, task, nth)
        self.opens = self.closes = None
        self.counts = {"illegal": 0, "blank": 0, "duplicate": 0, "truncated": 0}
        self.codes, self.gone, self.turns, self.names = bytearray(), [0], [], []

    def add(self, turn, name, initial, fault, copies, first) -> None:
        if self.opens is None:
            self.opens = initial
        else:
            self.counts["illegal"] += self.closes + initial not in ("su", "ua", "au")
        # Copies stand side by side, and no role may follow itself.
        self.counts["illegal"] += copies - 1
        self.closes = initial
        if fault == "blank":
            self.counts["blank"] += copies
            self.gone[-1] += copies
            return
        live = int(first)
        if live:
            self.counts["truncated"] += fault == "truncated"
            code = "sua".find(initial) if initial else -1
            self.codes.append((code if code >= 0 else 3) * 2 + (fault == "truncated"))
            self.turns.append(turn)
            self.names.append(name)
            self.gone.append(0)
        self.counts["duplicate"] += copies - live
        self.gone[-1] += copies - live

    def row(self) -> tuple:
        return (
            *self.key, self.opens, self.closes, *self.counts.values(),
            bytes(self.codes), self.gone, self.turns, self.names,
        )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


_CHUNK_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()), ("task", pa.int32()), ("nth", pa.int32()),
        ("opens", pa.string()), ("closes", pa.string()), ("illegal", pa.int64()),
        ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
        ("codes", pa.binary()), ("gone", pa.list_(pa.int64())),
        ("turns", pa.list_(pa.int64())), ("names", pa.list_(pa.binary())),
    ]
)


def _chunker(size: int):
    """Sorted rows to chunks of at most ``size`` distinct rows."""

    def run(batches):
        task, held, n, chunk = TaskContext.get().partitionId(), [], 0, None
        for batch in batches:
            for conv_id, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                same = chunk is not None and chunk.key[0] == conv_id
                if not same or n == size:
                    if chunk is not None:
                        held.append(chunk.row())
                    chunk, n = _Chunk(conv_id, task, chunk.key[2] + 1 if same else 0), 0
                chunk.add(*row)
                n += 1
                if len(held) >= 1024:
                    yield _batch(held, _CHUNK_SCHEMA)
                    held = []
        if chunk is not None:
            held.append(chunk.row())
        yield _batch(held, _CHUNK_SCHEMA)

    return run


def _starts(batches):
    """The vector at the start of each chunk, from the one at its end."""
    for batch in batches:
        keys = [batch.column(c) for c in ("conv_id", "task", "nth")]
        ends, starts = [], []
        for codes, end in zip(batch.column("codes").to_pylist(), batch.column("end").to_pylist(), strict=True):
            ends.append(end)
            vector = tuple(end)
            for code in reversed(codes):
                vector = _relative(_back(code, vector))
            starts.append(list(vector))
        kind = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays(
            [*keys, pa.array(ends, kind), pa.array(starts, kind)], ["conv_id", "task", "nth", "end", "start"]
        )


_KEY = ["conv_id", "task", "nth"]
_VECTORS = "conv_id bigint, task int, nth int, end array<int>, start array<int>"


def _same_key(left: DataFrame, right: DataFrame) -> Column:
    return (
        left["conv_id"].eqNullSafe(right["conv_id"])
        & (left["task"] == right["task"])
        & (left["nth"] == right["nth"])
    )


def _stitched(chunks: DataFrame) -> tuple[DataFrame, bool]:
    """Chunks with the vector at their ``end``, exact up to a constant."""
    finished = F.array(*[F.lit(c) for c in FINISHED])
    order = W.partitionBy("conv_id").orderBy("task", "nth")
    codes = chunks.select(*_KEY, "codes")
    several = chunks.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1")
    if several.isEmpty():  # nothing to stitch
        return chunks.withColumn("end", finished), False
    found = stored(in_arrow(codes.withColumn("end", finished), _starts, _VECTORS), "speculative_costs")
    while True:
        after = F.coalesce(F.lead("start").over(order), finished)
        wanted = stored(found.withColumn("wanted", after), "costs_after")
        stale = wanted.where("wanted != end")
        if stale.isEmpty():
            break
        again = codes.join(stale.select(*[F.col(k).alias(f"_{k}") for k in _KEY], F.col("wanted").alias("end")),
            F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("task") == F.col("_task")) & (F.col("nth") == F.col("_nth")),
        )
        rerun = in_arrow(again.select(*_KEY, "codes", "end"), _starts, _VECTORS)
        kept = wanted.where("wanted = end").drop("wanted")
        found = stored(kept.unionByName(rerun), "costs")
    joined = chunks.join(found, _same_key(chunks, found)).select(*[chunks[c] for c in chunks.columns], found["end"])
    return joined, True


_TRACED = pa.schema(
    [
        ("conv_id", pa.int64()), ("task", pa.int32()), ("nth", pa.int32()),
        ("state", pa.int32()), ("leaves", pa.int32()), ("audit", pa.string()), ("cost", pa.int64()),
        ("edits", pa.list_(pa.struct([("turn", pa.int64()), ("name", pa.binary()), ("role", pa.string())]))),
    ]
)
_TRACES = (
    "conv_id bigint, task int, nth int, state int, leaves int, audit string, cost bigint, "
    "edits array<struct<turn:bigint,name:binary,role:string>>"
)


def _trace(codes: bytes, gone: list, turns: list, names: list, end: tuple, state: int, last: bool):
    """Letters, cost, the state at the end and the rows that remain, in order."""
    after = _vectors(codes, end)[1:]
    letters, cost, edits = [], 0, []

    def insert(times: int, at: int) -> int:
        for _ in range(times):
            at = _FORWARD[at]
            edits.append({"turn": None, "name": None, "role": _ROLES[at]})
        return at

    for code, dropped, vector, turn, name in zip(codes, gone, after, turns, names, strict=False):
        text, price, onward, role = _edit(code, vector, state)
        insert(len(text) - 1, state)
        if role is not None:
            edits.append({"turn": turn, "name": name, "role": role})
        letters.append("D" * dropped + text)
        cost += DELETE * dropped + price
        state = onward
    letters.append("D" * gone[-1])
    cost += DELETE * gone[-1]
    if last:
        missing = FINISHED[state] // INSERT
        state = insert(missing, state)
        letters.append("I" * missing)
        cost += INSERT * missing
    return state, "".join(letters), cost, edits


def _tracer(batches):
    for batch in batches:
        held, size = [], 0
        for row in batch.to_pylist():
            states = [START] if row["opens_all"] else range(4)
            for state in states:
                parts = (bytes(row["codes"]), row["gone"], row["turns"], row["names"], tuple(row["end"]))
                leaves, audit, cost, edits = _trace(*parts, state, row["ends_all"])
                held.append((row["conv_id"], row["task"], row["nth"], state, leaves, audit, cost, edits))
                size += len(edits)
            if size > 1 << 14:
                yield _batch(held, _TRACED)
                held, size = [], 0
        yield _batch(held, _TRACED)


def _chosen(traces: DataFrame) -> DataFrame:
    """Of the traces of a chunk the one whose state the chunk before leaves."""
    light = traces.groupBy(*_KEY).agg(
        F.map_from_entries(F.collect_list(F.struct("state", "leaves"))).alias("leaves")
    )
    order = W.partitionBy("conv_id").orderBy("task", "nth")
    # A chunk of many rows nearly always ends in one state, from wherever it starts.
    guess = F.map_values("leaves")[0]
    found = stored(light.withColumn("enter", F.coalesce(F.lag(guess).over(order), F.lit(START))), "entered")
    while True:
        onward = F.coalesce(F.lag(F.col("leaves")[F.col("enter")]).over(order), F.lit(START))
        wanted = stored(found.withColumn("wanted", onward), "entered")
        if wanted.where("wanted != enter").isEmpty():
            break
        found = wanted.select(*_KEY, "leaves", F.col("wanted").alias("enter"))
    return traces.join(found, _same_key(traces, found) & (traces["state"] == found["enter"])).select(
        *[traces[c] for c in traces.columns]
    )


def repair(rows: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """The repaired rows, and what was wrong per conversation.

    ``rows`` are ``(conv_id, turn, role, text)``; ``copies`` may say how often a row
    stands there. They are read by turn, null first; equal turns by role, then by a
    digest of the text. Null roles and texts are one space. A null conv_id is a
    conversation as well. Repeated rows are duplicates. Other columns are ignored.

    The first result is ``(conv_id, task, nth, place, role, text)``: the rows that
    remain and the inserted ones, in the order of task, nth and place. The second is
    ``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)``, a row per
    conversation that has rows.
    """
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    rows = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        copies.cast("bigint").alias("copies"),
    )
    light = with_faults(rows)
    places = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("name")]
    by = F.col("conv_id").asc_nulls_first()
    dealt = light.repartitionByRange(by, *places).sortWithinPartitions(by, *places)
    columns = ["conv_id", "turn", "name", "initial", "fault", "copies", "first"]
    chunks = stored(in_arrow(dealt.select(columns), _chunker(chunk), _CHUNKS), "chunks")
    order = W.partitionBy("conv_id").orderBy("task", "nth")
    stitched, several = _stitched(chunks)
    ready = stitched.select(
        *_KEY, "codes", "gone", "turns", "names", "end",
        F.lag("nth").over(order).isNull().alias("opens_all"),
        F.lead("nth").over(order).isNull().alias("ends_all"),
    )
    traces = stored(in_arrow(ready, _tracer, _TRACES), "traces")
    if several:
        traces = stored(_chosen(traces), "chosen_traces")
    return _repaired(rows, traces), _report(light, chunks, traces)


def _repaired(rows: DataFrame, traces: DataFrame) -> DataFrame:
    edits = traces.select(*_KEY, F.posexplode("edits").alias("place", "edit")).select(
        *_KEY, "place", "edit.turn", "edit.name", F.col("edit.role").alias("new_role")
    )
    name = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    # Equal rows are one here; the others were duplicates.
    texts = rows.select(
        F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), name.alias("_n"), "role", "text"
    ).dropDuplicates(["_c", "_t", "_n"])
    kept = edits.where("name is not null").join(
        texts,
        F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t")) & (F.col("name") == F.col("_n")),
    )
    role = F.when(F.col("new_role") == "", F.col("role")).otherwise(F.col("new_role"))
    inserted = edits.where("name is null").select(
        *_KEY, "place", F.col("new_role").alias("role"), F.lit("").alias("text")
    )
    return kept.select(*_KEY, "place", role.alias("role"), "text").unionByName(inserted)


def _report(light: DataFrame, chunks: DataFrame, traces: DataFrame) -> DataFrame:
    order = W.partitionBy("conv_id").orderBy("task", "nth")
    seam = F.concat(F.lag("closes").over(order), F.col("opens"))
    counted = (
        chunks.select(
            "conv_id", "blank", "duplicate", "truncated",
            (F.col("illegal") + F.coalesce((~seam.isin("su", "ua", "au")).cast("bigint"), F.lit(0))).alias("illegal"),
        )
        .groupBy("conv_id")
        .agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    )
    distinct = light.groupBy("conv_id", "turn").agg(F.count("*").alias("n"))
    gaps = distinct.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")
    )
    # One text per conversation, of one letter per edit: a cell of the result.
    pieces = F.sort_array(F.collect_list(F.struct("task", "nth", "audit")))
    audits = traces.groupBy("conv_id").agg(
        F.sum("cost").alias("cost"), F.array_join(F.transform(pieces, lambda p: p["audit"]), "").alias("audit")
    )

    def keyed(df: DataFrame, name: str) -> DataFrame:
        return df.withColumnRenamed("conv_id", name)

    return (
        counted.join(keyed(gaps, "_g"), F.col("conv_id").eqNullSafe(F.col("_g")))
        .join(keyed(audits, "_a"), F.col("conv_id").eqNullSafe(F.col("_a")))
        .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    )

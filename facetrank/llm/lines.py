"""Line deduplication by a deletion-neighbourhood join.

A line is its sequence of words. Two lines are near if one word inserted, removed
or replaced turns one into the other. Each line gives a hashed key for itself and
for every variant with one word left out. Near lines share a variant: equal keys
with the same place left out are a replacement, and a variant equal to a whole
line is an insertion. A line is dropped if an equal or near line comes earlier.

Full neighbourhoods are only made for lines that can have a partner. For that,
words are cut into chunks at words chosen by their hash, and a line first gives
one key per chunk, and per pair of adjacent chunks, left out. An edit changes one
chunk, or joins or splits two, so near lines share such a key too; lines whose
keys meet no other line have no partner. Short lines skip this test.

Groups of equal keys are read as sorted streams that hold one row, and yield one
pair per member: with the earliest of its group. Hashes of variants only propose;
each pair is checked on its words. Equal lines are those of equal names, 64 bits that
words in order are mixed into.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetrank.llm.common import in_arrow, shuffle_partitions, stored
from facetrank.llm.words import bytes_of, hashes_between, parts_of, spread, word_hashes

CHUNK_WORDS = 8
_PART_BYTES = 4 << 20
_LAST = (1 << 63) - 1  # stands for a null doc_id when lines are ordered

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 ... base^(n-1), modulo 2^64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        factors = np.full(max(n, 1024), base, np.uint64)
        factors[0] = 1
        known = _powers[base] = np.cumprod(factors, dtype=np.uint64)
    return known[:n]


def line_names(words: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A name for each line of at least one word, from its words in order.

    Neighbouring words are mixed in pairs until one number is left. Unlike sums of
    powers, no pattern of two words repeats in the result.
    """
    mixed, count = spread(words + np.uint64(_BASE)), n.astype(np.int64)
    while len(count) and count.max() > 1:
        owner = np.repeat(np.arange(len(count)), count)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        left = np.flatnonzero(place % 2 == 0)
        of = count[owner[left]]
        right = mixed[np.minimum(left + 1, len(mixed) - 1)]
        right[place[left] + 1 >= of] = 0  # the last of an odd number
        pairs = spread(mixed[left] * np.uint64(_BASE) + spread(right ^ np.uint64(_INVERSE)))
        mixed = np.where(of > 1, pairs, mixed[left])
        count = (count + 1) // 2
    return spread(mixed ^ spread(n.astype(np.uint64)))


class Hashed:
    """Prefix sums of the words of many lines, from which any part can be left out."""

    def __init__(self, words: np.ndarray, n: np.ndarray):
        self.words, self.n = words, n
        self.start = np.cumsum(n) - n
        self.place = np.arange(len(words)) - np.repeat(self.start, n)
        longest = int(n.max()) if len(n) else 0
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * _power(_BASE, longest)[self.place], out=self.sums[1:])
        self.inverse = _power(_INVERSE, longest + 1)

    def without(self, line: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Keys of lines without their words first..after-1."""
        at, gone = self.start[line], after - first
        head = self.sums[at + first] - self.sums[at]
        tail = self.sums[at + self.n[line]] - self.sums[at + after]
        rest = head + tail * self.inverse[gone]
        return spread(rest ^ spread((self.n[line] - gone).astype(np.uint64)))

    def chunk_keys(self, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of the lines whole and without one chunk or two: line, key; and short lines.

        A line is short if leaving chunks out can leave nothing.
        """
        chosen = np.zeros(len(self.n), bool)
        chosen[lines] = True
        owner = np.repeat(np.arange(len(self.n)), self.n)
        cut = chosen[owner] & ((self.words >> np.uint64(7)) % np.uint64(CHUNK_WORDS) == 0)
        cut &= self.place + 1 < self.n[owner]
        line = np.concatenate([lines, owner[cut], lines])
        edge = np.concatenate([np.zeros_like(lines), self.place[cut] + 1, self.n[lines]])
        order = np.lexsort((edge, line))
        line, edge = line[order], edge[order]
        edges = np.bincount(line, minlength=len(self.n))
        short = lines[edges[lines] <= 3]
        found = [(lines, np.zeros_like(lines), np.zeros_like(lines))]
        for step in (1, 2):
            same = line[:-step] == line[step:]
            found.append((line[:-step][same], edge[:-step][same], edge[step:][same]))
        line, first, after = (np.concatenate(x) for x in zip(*found, strict=True))
        long = edges[line] > 3
        line, first, after = line[long], first[long], after[long]
        return line, self.without(line, first, after), short


def _lines_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the texts; edges of all their lines; text and number in it of each line."""
    data, at = bytes_of(column)
    breaks = np.flatnonzero(data == 10) + 1
    per_text = np.diff(np.searchsorted(breaks, at, "right")) + 1
    text = np.repeat(np.arange(len(per_text)), per_text)
    number = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    edges = np.empty(len(text) + 1, np.int64)
    edges[:-1][number == 0] = at[:-1]
    edges[:-1][number > 0] = breaks
    edges[-1] = at[-1]
    return data, edges, text, number


_PLACES = "doc_id bigint, text_hash bigint, line bigint, place int, keys array<bigint>, short boolean"


def _places(batches):
    """A row per line with words; chunk keys once per distinct line of a batch part."""
    for batch in batches:
        for part in parts_of(batch, 2, _PART_BYTES):
            data, edges, text, number = _lines_of(part.column(2))
            words, n = hashes_between(data, edges, lower=False)
            filled = np.flatnonzero(n)
            hashed = Hashed(words, n[filled])
            names = line_names(words, n[filled])
            distinct = np.sort(np.unique(names, return_index=True)[1])
            line, keys, short = hashed.chunk_keys(distinct)
            order = np.argsort(line, kind="stable")
            ends = np.cumsum(np.bincount(line, minlength=len(filled)))
            is_short = np.zeros(len(filled), bool)
            is_short[short] = True
            own = pa.array(text[filled])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(own),
                    part.column(1).take(own),
                    pa.array(names.view(np.int64)),
                    pa.array(number[filled], pa.int32()),
                    pa.ListArray.from_arrays(
                        pa.array(np.r_[0, ends], pa.int32()), pa.array(keys[order].view(np.int64))
                    ),
                    pa.array(is_short),
                ],
                ["doc_id", "text_hash", "line", "place", "keys", "short"],
            )


def _meeting(batches):
    """Lines that share a key with another line, from rows sorted by key and line."""
    last_key = last_line = None
    for batch in batches:
        key, line = (np.array(c) for c in batch.columns)
        if last_key is not None:
            key, line = np.concatenate([[last_key], key]), np.concatenate([[last_line], line])
        if len(key):
            meet = (key[1:] == key[:-1]) & (line[1:] != line[:-1])
            found = np.unique(np.concatenate([line[1:][meet], line[:-1][meet]]))
            last_key, last_line = key[-1], line[-1]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["line"])


def _texts(batches):
    """Distinct lines of a batch part with their bytes."""
    for batch in batches:
        for part in parts_of(batch, 0, _PART_BYTES):
            data, edges, _, _ = _lines_of(part.column(0))
            words, n = hashes_between(data, edges, lower=False)
            filled = np.flatnonzero(n)
            names = line_names(words, n[filled])
            distinct = np.sort(np.unique(names, return_index=True)[1])
            pieces = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(data.tobytes())]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names[distinct].view(np.int64)),
                    pieces.take(pa.array(filled[distinct])).cast(pa.binary()),
                ],
                ["line", "words"],
            )


_VARIANTS = "key bigint, left_out int, line bigint, first_doc bigint, first_place int"


def _variants(batches):
    """A key for the whole line (nothing left out: -1) and for each word left out."""
    for batch in batches:
        for part in parts_of(batch, 3, _PART_BYTES // 8):
            words, n = word_hashes(part.column(3), lower=False)
            hashed = Hashed(words, n)
            line = np.repeat(np.arange(len(n)), n + 1)
            left_out = np.arange(len(line)) - np.repeat(np.cumsum(n + 1) - (n + 1), n + 1) - 1
            keys = hashed.without(line, np.maximum(left_out, 0), left_out + 1)
            again = pa.array(line)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys.view(np.int64)),
                    pa.array(left_out, pa.int32()),
                    *(part.column(i).take(again) for i in range(3)),
                ],
                ["key", "left_out", "line", "first_doc", "first_place"],
            )


def _proposals(batches):
    """``(line, earlier)`` from rows sorted by key, place left out, and first place."""
    key = whole = head = place = None
    for batch in batches:
        out = []
        keys = np.array(batch.column(0))
        shared = np.ones(len(keys), bool)  # with a neighbour; the ends may be, with other batches
        shared[1:-1] = (keys[1:-1] == keys[:-2]) | (keys[1:-1] == keys[2:])
        rows = batch.filter(pa.array(shared))
        for now, left_out, line, *first in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            if now != key:
                key, whole, head, place = now, None, None, None
            if left_out < 0:
                whole = whole or (first, line)
                continue
            if left_out != place:
                place, head = left_out, (first, line)
                if whole and head[0] < whole[0]:
                    out.append((whole[1], line))
            elif line != head[1]:
                out.append((line, head[1]))
            if whole and whole[0] < first:
                out.append((line, whole[1]))
        columns = list(zip(*out, strict=True)) or [(), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["line", "earlier"]
        )


def within_one_word(a: list[bytes], b: list[bytes]) -> bool:
    """Whether one word inserted, removed or replaced, or nothing, turns a into b."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def _verified(batches):
    for batch in batches:
        lines = [
            line
            for line, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True)
            if within_one_word(a.split(), b.split())
        ]
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.int64())], ["line"])


def _rebuilt(batches):
    for batch in batches:
        doc_ids, texts, drops = (c.to_pylist() for c in batch.columns)
        kept, counts, gone = [], [], []
        for text, drop in zip(texts, drops, strict=True):
            counts.append(text.count(b"\n") + 1)
            gone.append(len(drop or ()))
            if drop:
                without = set(drop)
                lines = enumerate(text.split(b"\n"))
                text = b"\n".join(x for i, x in lines if i not in without)
            kept.append(text.decode())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(doc_ids, pa.int64()),
                pa.array(counts, pa.int64()),
                pa.array(gone, pa.int64()),
                pa.array(kept, pa.string()),
            ],
            ["doc_id", "n_lines", "n_dropped", "text"],
        )


def _near(source: DataFrame, places: DataFrame, firsts: DataFrame) -> DataFrame:
    """Lines with an earlier near line."""
    parts = shuffle_partitions(source.sparkSession)
    coarse = (
        places.select(F.explode("keys").alias("key"), "line")
        .repartition(parts, "key")
        .sortWithinPartitions("key", "line")
    )
    partnered = in_arrow(coarse, _meeting, "line bigint").union(places.where("short").select("line"))
    partnered = stored(partnered.distinct(), "partnered_lines")
    texts = (
        in_arrow(source.select("text"), _texts, "line bigint, words binary")
        .join(partnered, "line", "left_semi")
        .dropDuplicates(["line"])
    )
    open_lines = stored(
        texts.join(firsts, "line").select("line", "first.doc", "first.place", "words"), "open_lines"
    )
    variants = (
        in_arrow(open_lines, _variants, _VARIANTS)
        .repartition(parts, "key")
        .sortWithinPartitions("key", "left_out", "first_doc", "first_place")
    )
    pairs = stored(
        in_arrow(variants, _proposals, "line bigint, earlier bigint").distinct(), "line_pairs"
    )
    words = open_lines.select("line", "words")
    earlier = words.select(F.col("line").alias("earlier"), F.col("words").alias("earlier_words"))
    proposed = pairs.join(words, "line").join(earlier, "earlier")
    return in_arrow(
        proposed.select("line", "words", "earlier_words"), _verified, "line bigint"
    ).distinct()


def deduplicated_lines(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped and the text that is left.

    A line that has words is dropped if a line of the same words, or of words
    within one edit, comes earlier by (doc_id, line number), kept or not. Lines
    without words stay. A null doc_id comes after all others; rows that repeat
    doc_id and text keep the same lines. Null and empty texts have one empty
    line. Other columns are ignored; an empty table gives no rows.
    """
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    places = stored(in_arrow(source, _places, _PLACES), "line_places")
    order = F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), "place")
    firsts = stored(
        places.groupBy("line").agg(
            F.min(order).alias("first"), (F.count("*") > 1).alias("repeated")
        ),
        "first_places",
    )
    near = _near(source, places, firsts)
    marked = stored(
        firsts.join(near.withColumn("near", F.lit(True)), "line", "left")
        .where("near or repeated")
        .select(F.col("line").alias("marked"), "first", F.coalesce("near", F.lit(False)).alias("near")),
        "marked_lines",
    )
    is_first = (F.coalesce("doc_id", F.lit(_LAST)) == F.col("first.doc")) & (
        F.col("place") == F.col("first.place")
    )
    drops = (
        places.select("doc_id", "text_hash", "line", "place")
        .join(marked, F.col("line") == F.col("marked"))
        .where(F.col("near") | ~is_first)
        .groupBy(F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash"))
        .agg(F.collect_set("place").alias("drop"))
    )
    together = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash"))
    return in_arrow(
        source.join(drops, together, "left").select("doc_id", "text", "drop"),
        _rebuilt,
        "doc_id bigint, n_lines bigint, n_dropped bigint, text string",
    )

"""Language-model scores from a hierarchical Pitman-Yor model.

Each context (the word before) is a restaurant whose customers are the words that
follow it in training; a table serves one word, and every table sends a customer
to the parent restaurant that all contexts share, whose own parent is the uniform
distribution over the known words and one unknown. Seating is sampled by Gibbs
moves: a customer leaves its table and sits down again with the probabilities of
the Chinese-restaurant process. Predictive probabilities are averaged over kept
sweeps.

On the cluster, text is read once into packed counts of (context, word, document)
which are dealt into buckets by context; contexts too large for one are dealt by
pair, and only their two totals are shared. A bucket samples its restaurants with
the parent's probabilities of the round before; between rounds, tables per word
are summed and the parent is sampled anew. So moves within a sweep see the table
totals and parent from its start, the usual approximation of parallel Gibbs.
A pair seen once always has one table and is not sampled.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetrank.llm.common import (
    discard,
    freed_shuffles,
    in_arrow,
    ship,
    shuffle_partitions,
    stored,
)
from facetrank.llm.words import parts_of, spread, word_hashes
from facetrank.session import scratch_database, scratch_name
from facetrank.sinks.tables import overwrite_table

BUCKET_TOKENS = 1_500_000
PACKED_TOKENS = 1_000_000
CONCENTRATION = 1.0
BURN_IN = 2
KEPT = 3
SEED = 11
_PART_BYTES = 4 << 20
_SAMPLED = 0.05
_MATRIX = 1 << 18

# No word holds a blank.
START = xxhash.xxh3_64_intdigest(b" start")
END = xxhash.xxh3_64_intdigest(b" end")


def is_held_out(doc_id: int | None) -> bool:
    """Rows never learnt from: crc32 of the id as text, mod 7, is 2. Null ids are learnt from."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def column_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts of a binary column, each with its end, and tokens per text."""
    words, n = word_hashes(column)
    tokens = np.empty(len(words) + len(n), np.uint64)
    text = np.repeat(np.arange(len(n)), n)
    tokens[np.arange(len(words)) + text] = words
    tokens[np.cumsum(n + 1) - 1] = END
    return tokens, n + 1


def token_hashes(text: bytes) -> np.ndarray:
    """Tokens of one text, with its end."""
    return column_hashes(pa.array([text], pa.binary()))[0]


# --- Packing -----------------------------------------------------------------


def _packed(arrays: list[np.ndarray]) -> bytes:
    """Arrays with their kinds and lengths, by columns of bytes, compressed."""
    parts = [len(arrays).to_bytes(1, "little")]
    for a in arrays:
        parts += [a.dtype.str[1:].encode(), len(a).to_bytes(8, "little")]
        parts.append(np.ascontiguousarray(a.view("u1").reshape(len(a), -1).T).tobytes())
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _unpacked(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    at, out = 1, []
    for _ in range(raw[0]):
        kind, n = np.dtype("<" + raw[at : at + 2].decode()), int.from_bytes(raw[at + 2 : at + 10], "little")
        at += 10
        columns = np.frombuffer(raw, "u1", n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(columns.T).view(kind).reshape(n))
        at += n * kind.itemsize
    return out


def _narrow(a: np.ndarray) -> np.ndarray:
    top = int(a.max()) if len(a) else 0
    return a.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8")


def _pack_bucket(u: np.ndarray, w: np.ndarray, row: np.ndarray) -> bytes:
    """Entries of a bucket, sorted, as runs: contexts, words of each, rows of each pair."""
    contexts, u_at = np.unique(u, return_inverse=True)
    words, w_at = np.unique(w, return_inverse=True)
    order = np.lexsort((row, w_at, u_at))
    u_at, w_at, row = u_at[order], w_at[order], row[order]
    new_pair = np.r_[True, (np.diff(u_at) != 0) | (np.diff(w_at) != 0)]
    new_entry = new_pair | np.r_[True, np.diff(row) != 0]
    entry = np.flatnonzero(new_entry)
    counts = np.diff(np.r_[entry, len(row)])
    pair_at = np.flatnonzero(new_pair)
    per_pair = np.diff(np.r_[np.searchsorted(entry, pair_at), len(entry)])
    base = int(row.min())
    return _packed(
        [
            np.diff(contexts, prepend=np.uint64(0)).astype("<u8"),
            np.diff(words, prepend=np.uint64(0)).astype("<u8"),
            _narrow(np.bincount(u_at[pair_at], minlength=len(contexts))),
            _narrow(w_at[pair_at]),
            _narrow(per_pair),
            _narrow(row[entry] - base),
            _narrow(counts),
            np.array([base], "<u8"),
        ]
    )


def _buckets_of(u: np.ndarray, w: np.ndarray, buckets: int, hot: np.ndarray) -> np.ndarray:
    by_context = spread(u) % np.uint64(buckets)
    if len(hot) == 0:
        return by_context.astype(np.int64)
    place = np.searchsorted(hot, u).clip(max=len(hot) - 1)
    by_pair = spread(spread(u) ^ w) % np.uint64(buckets)
    return np.where(hot[place] == u, by_pair, by_context).astype(np.int64)


_PACKED = "bucket int, packed binary, row bigint, doc_id bigint, n_tokens bigint, held_out boolean"
_PACKED_ARROW = pa.schema(
    [
        ("bucket", pa.int32()),
        ("packed", pa.binary()),
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("held_out", pa.bool_()),
    ]
)


def _pack(buckets: int, hot):
    """Documents to packed buckets, and one row about each document (packed null)."""

    def flush(held, hot_now):
        w, u, rows = (np.concatenate(x) for x in zip(*held, strict=True))
        at = _buckets_of(u, w, buckets, hot_now)
        order = np.argsort(at, kind="stable")
        cuts = np.searchsorted(at[order], np.arange(buckets + 1))
        filled = np.flatnonzero(np.diff(cuts))
        packed = []
        for bucket in filled:
            part = order[cuts[bucket] : cuts[bucket + 1]]
            packed.append(_pack_bucket(u[part], w[part], rows[part]))
        nothing = [pa.nulls(len(filled), field.type) for field in list(_PACKED_ARROW)[2:]]
        return pa.RecordBatch.from_arrays(
            [pa.array(filled, pa.int32()), pa.array(packed, pa.binary()), *nothing], schema=_PACKED_ARROW
        )

    def run(batches):
        hot_now = np.array(hot.value, np.uint64)
        row = TaskContext.get().partitionId() << 33
        held, tokens = [], 0
        for batch in batches:
            for part in parts_of(batch, 1, _PART_BYTES):
                doc_ids = part.column(0).to_pylist()
                out = np.array([is_held_out(d) for d in doc_ids], bool)
                # The row number carries the fold, so that entries need no flag.
                rows = 2 * (row + np.arange(len(doc_ids))) + out
                row += len(doc_ids)
                w, n = column_hashes(part.column(1))
                u = np.r_[np.uint64(START), w[:-1]]
                u[np.r_[0, np.cumsum(n)[:-1]]] = START
                held.append((w, u, np.repeat(rows, n).astype(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows % buckets, pa.int32()),
                        pa.nulls(len(rows), pa.binary()),
                        pa.array(rows, pa.int64()),
                        part.column(0),
                        pa.array(n, pa.int64()),
                        pa.array(out),
                    ],
                    schema=_PACKED_ARROW,
                )
                tokens += len(w)
                if tokens >= PACKED_TOKENS:
                    yield flush(held, hot_now)
                    held, tokens = [], 0
        if held:
            yield flush(held, hot_now)

    return run


class Bucket:
    """The pairs of a bucket in order, and the document entries of each."""

    def __init__(self, packed: list[bytes]):
        us, ws, pairs, rows, counts = [], [], [], [], []
        known = 0
        for data in sorted(packed):
            contexts, words, per_context, w_at, per_pair, row, n, base = _unpacked(data)
            us.append(np.repeat(np.cumsum(contexts, dtype=np.uint64), per_context))
            ws.append(np.cumsum(words, dtype=np.uint64)[w_at])
            pairs.append(np.repeat(np.arange(len(w_at)), per_pair) + known)
            rows.append(row.astype(np.int64) + int(base[0]))
            counts.append(n.astype(np.int64))
            known += len(w_at)
        u, w = np.concatenate(us), np.concatenate(ws)
        order = np.lexsort((w, u))
        u, w = u[order], w[order]
        new = np.r_[True, (u[1:] != u[:-1]) | (w[1:] != w[:-1])]
        merged = np.empty(known, np.int64)
        merged[order] = np.cumsum(new) - 1
        self.pair = merged[np.concatenate(pairs)]
        self.row, self.n = np.concatenate(rows), np.concatenate(counts)
        self.contexts, self.u = np.unique(u[new], return_inverse=True)
        self.words, self.w = np.unique(w[new], return_inverse=True)
        training = np.where(self.row % 2 == 0, self.n, 0)
        self.c = np.bincount(self.pair, training, len(self.u)).astype(np.int64)

    def per_word(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.w, values, len(self.words)).astype(np.int64)

    def per_context(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.u, values, len(self.contexts))


# --- Seating -----------------------------------------------------------------


def seat(customers, prior, at, others, strength, discount, rng, burn_in, kept):
    """Gibbs seating of cells (a word in a restaurant) with two customers or more.

    ``customers`` and ``prior`` (the parent's probability) are per cell, ``at`` is
    the cell's restaurant, ``others`` the tables of a restaurant that are not
    sampled here. A sweep reseats every customer of every cell once, in random order.
    Returns the mean number of tables per cell over the kept sweeps.
    """
    if len(customers) == 0:
        return np.zeros(0)
    tables = np.ones(len(customers))
    total = others + np.bincount(at, tables, len(others))
    weight = (strength + discount * total[at]) * prior
    # A start near the expected number; sweeps correct it.
    tables = 1 + np.floor(np.minimum(customers - 1, weight * np.log1p((customers - 1) / (1 + weight))))
    level = np.ceil(np.log2(customers)).astype(np.int64)
    states = []
    for size in np.unique(level):
        cells = np.flatnonzero(level == size)
        cells = cells[np.argsort(tables[cells], kind="stable")]
        first = 0
        while first < len(cells):
            wide = int(min(1 << size, max(4, 4 * tables[cells[first]])))
            last = min(len(cells), first + max(1, _MATRIX // wide))
            part = cells[first:last]
            wide = int(max(wide, tables[part].max()))
            sizes = np.zeros((len(part), wide))
            sizes[:, :] = np.arange(wide)[None, :] < tables[part][:, None]
            sizes[:, 0] += customers[part] - tables[part]
            states.append([part, sizes])
            first = last
    mean = np.zeros(len(customers))
    for sweep in range(burn_in + kept):
        total = others + np.bincount(at, tables, len(others))
        weight = (strength + discount * total[at]) * prior
        for state in states:
            part, sizes = state
            state[1] = _sweep(sizes, customers[part], weight[part], discount, rng)
            tables[part] = (state[1] > 0).sum(1)
        if sweep >= burn_in:
            mean += tables / kept
    return mean


def _sweep(sizes, customers, weight, discount, rng):
    """Every customer of every cell leaves its table and sits down again once, in random order.

    A customer that sits down where it sat changes nothing. So of a cell's customers
    whose turn is still to come, the first that will sit down elsewhere is drawn
    directly, with how many of each table had their turn before it: turns are at
    uniform times, and until that one the probabilities stay as they are. A step
    moves one customer of each cell; a cell whose other customers all stay is done.
    """
    waiting = sizes.astype(np.int64)
    cells = np.arange(len(sizes))
    while len(cells):
        n, turns, opening, total = sizes[cells], waiting[cells], weight[cells], customers[cells]
        alone = n == 1
        stay = np.where(alone, opening[:, None], n - 1 - discount)
        places = (total - 1 + opening)[:, None] - discount * ((n > 0).sum(1)[:, None] - alone)
        moving = np.clip(np.where(turns > 0, 1 - stay / places, 0.0), 0.0, 1.0)
        with np.errstate(divide="ignore"):
            time = -np.expm1(np.log(rng.random(n.shape)) / np.maximum(turns, 1))
            time = np.where(moving > 0, time / np.where(moving > 0, moving, 1.0), np.inf)
        first = time.argmin(1)
        going = np.flatnonzero(time.min(1) < 1)
        cells, n, turns, moving = cells[going], n[going], turns[going], moving[going]
        if len(cells) == 0:
            break
        first, opening, rows = first[going], opening[going], np.arange(len(going))
        now = time[going, first][:, None]
        turns[rows, first] -= 1
        had_turn = now * (1 - moving) / np.maximum(1 - moving * now, 1e-300)
        waiting[cells] = turns - rng.binomial(turns, np.clip(had_turn, 0.0, 1.0))
        n[rows, first] -= 1
        pull = np.where(n > 0, n - discount, 0.0)
        pull[rows, first] = 0.0
        pull = np.cumsum(pull, 1)
        # Who left a table empty and opens one sits where it sat.
        opening = np.where(n[rows, first] > 0, opening, 0.0)
        choice = rng.random(len(rows)) * (pull[:, -1] + opening)
        table = (pull <= choice[:, None]).sum(1)
        beyond = table == n.shape[1]
        rounded = np.flatnonzero(beyond & (opening == 0))
        table[rounded] = (pull[rounded] >= pull[rounded, -1:]).argmax(1)
        opens = np.flatnonzero(beyond & (opening > 0))
        if len(opens):
            if not (n[opens] == 0).any(1).all():
                n, sizes, waiting = (np.hstack([x, np.zeros_like(x)]) for x in (n, sizes, waiting))
            table[opens] = (n[opens] == 0).argmax(1)
        n[rows, table] += 1
        sizes[cells] = n
    return sizes


def discount_of(once: int, twice: int) -> float:
    """The usual estimate from how many things were seen once and twice."""
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


# --- Rounds ------------------------------------------------------------------

_FACTS = "kind tinyint, key bigint, bucket int, c bigint, t bigint"
_WORD, _HOT, _SEEN = 0, 1, 2


def _facts(table: pa.Table, hot: np.ndarray) -> pa.Table:
    """Words of a bucket with counts and pairs; totals of hot contexts; pairs seen once and twice."""
    bucket = Bucket(table.column("packed").to_pylist())
    number = table.column("bucket")[0].as_py()
    seen = (bucket.c > 0).astype(np.int64)
    c, t = bucket.per_word(bucket.c), bucket.per_word(seen)
    split = np.isin(bucket.contexts, hot)
    columns = [
        ([_WORD] * len(c), bucket.words.view(np.int64), c, t),
        (
            [_HOT] * int(split.sum()),
            bucket.contexts[split].view(np.int64),
            bucket.per_context(bucket.c)[split].astype(np.int64),
            bucket.per_context(seen)[split].astype(np.int64),
        ),
        ([_SEEN], [0], [int((bucket.c == 1).sum())], [int((bucket.c == 2).sum())]),
    ]
    return pa.concat_tables(
        pa.table(
            {
                "kind": pa.array(kind, pa.int8()),
                "key": pa.array(key, pa.int64()),
                "bucket": pa.array([number] * len(kind), pa.int32()),
                "c": pa.array(c, pa.int64()),
                "t": pa.array(t, pa.int64()),
            }
        )
        for kind, key, c, t in columns
    )


class Seated:
    """A bucket after sampling: mean tables per pair and per context."""

    def __init__(self, packed, replies: pa.Table, model: dict, kept: int, burn_in: int = BURN_IN):
        self.bucket = b = Bucket(packed.column("packed").to_pylist())
        number = packed.column("bucket")[0].as_py()
        keys = np.array(replies.column("key")).astype(np.int64).view(np.uint64)
        order = np.argsort(keys)
        self.word_count = np.array(replies.column("c"))[order]
        self.prior = np.array(replies.column("prior"))[order]
        seen = b.c > 0
        again = np.flatnonzero(b.c >= 2)
        own = b.per_context(seen)
        self.context_count, extra = b.per_context(b.c), np.zeros(len(own))
        hot, hot_c, hot_t = model["hot"]
        if len(hot):
            place = np.searchsorted(hot, b.contexts).clip(max=len(hot) - 1)
            split = hot[place] == b.contexts
            self.context_count = np.where(split, hot_c[place], self.context_count)
            extra = np.where(split, hot_t[place] - own, 0.0)
            self.split = np.flatnonzero(split)
        else:
            self.split = np.zeros(0, np.int64)
        once = b.per_context(b.c == 1)
        rng = np.random.default_rng([SEED, number, kept])
        tables = seat(
            b.c[again].astype(float),
            self.prior[b.w[again]],
            b.u[again],
            once + extra,
            model["strength"],
            model["discount"],
            rng,
            burn_in,
            kept,
        )
        self.tables = seen.astype(float)
        self.tables[again] = tables
        self.own_tables = b.per_context(self.tables)
        self.context_tables = self.own_tables + extra


_TABLES = "kind tinyint, key bigint, t double"


def _sampled(model: dict):
    def run(packed: pa.Table, replies: pa.Table) -> pa.Table:
        seated = Seated(packed, replies, model, kept=1)
        b = seated.bucket
        more = np.bincount(b.w, seated.tables - (b.c > 0), len(b.words))
        words = np.flatnonzero(more)
        kinds = [_WORD] * len(words) + [_HOT] * len(seated.split)
        keys = np.r_[b.words[words], b.contexts[seated.split]].view(np.int64)
        values = np.r_[more[words], seated.own_tables[seated.split]]
        return pa.table(
            {"kind": pa.array(kinds, pa.int8()), "key": pa.array(keys), "t": pa.array(values)}
        )

    return run


# Sums of a bucket travel by blocks of documents, so that a document costs a few
# bytes per bucket and not a row.
BLOCK_BITS = 10
_BLOCKS = "block bigint, packed binary"
_SCORES = "row bigint, score double, base_score double, n_known bigint"


def _block_sums(packed: pa.Table) -> pa.Table:
    """Sums of all buckets for the documents of one block."""
    parts = [_unpacked(data) for data in sorted(packed.column("packed").to_pylist())]
    rows, at = np.unique(np.concatenate([p[0].view(np.int64) for p in parts]), return_inverse=True)
    score, base, known = (
        np.bincount(at, np.concatenate([p[i] for p in parts]), len(rows)) for i in (1, 2, 3)
    )
    return pa.table(
        {
            "row": pa.array(rows),
            "score": pa.array(score),
            "base_score": pa.array(base),
            "n_known": pa.array(known.astype(np.int64)),
        }
    )


def _scored(model: dict):
    def run(packed: pa.Table, replies: pa.Table) -> pa.Table:
        s = Seated(packed, replies, model, kept=KEPT)
        b, strength, discount = s.bucket, model["strength"], model["discount"]
        prior = s.prior[b.w]
        count = s.context_count[b.u]
        back_off = (strength + discount * s.context_tables[b.u]) * prior
        p = np.where(
            count > 0, (np.maximum(0, b.c - discount * s.tables) + back_off) / (strength + count), prior
        )
        c = s.word_count[b.w]
        base = np.log10((c + 1) / (model["tokens"] + model["words"] + 1))
        rows, at = np.unique(b.row, return_inverse=True)
        per_row = lambda values: np.bincount(at, values[b.pair] * b.n, len(rows))
        sums = per_row(np.log10(p)), per_row(base), per_row((c > 0).astype(float))
        block = rows >> BLOCK_BITS
        cuts = np.r_[0, np.flatnonzero(np.diff(block)) + 1, len(rows)]
        packed_sums = [
            _packed([rows[i:j].astype("<u8"), sums[0][i:j], sums[1][i:j], _narrow(sums[2][i:j])])
            for i, j in zip(cuts[:-1], cuts[1:], strict=True)
        ]
        return pa.table(
            {"block": pa.array(block[cuts[:-1]]), "packed": pa.array(packed_sums, pa.binary())}
        )

    return run


_SEATED_WORDS = 500_000


def _root_tables(uniform: float, discount: float, tables: float):
    """Words, dealt and sorted by key, to their tables in the parent restaurant.

    Many words are sampled together; how Arrow cuts batches does not matter.
    """

    def sampled(batches, number):
        table = pa.Table.from_batches(batches)
        t = np.array(table.column("t"))
        out = (t > 0).astype(float)
        again = np.flatnonzero(t >= 2)
        out[again] = seat(
            np.round(t[again]),
            np.full(len(again), uniform),
            np.zeros(len(again), np.int64),
            np.array([tables - len(again)]),
            CONCENTRATION,
            discount,
            np.random.default_rng([SEED, TaskContext.get().partitionId(), number]),
            BURN_IN,
            KEPT,
        )
        return table.append_column("root", pa.array(out, pa.float64())).to_batches()

    def run(batches):
        held, rows, number = [], 0, 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, _SEATED_WORDS - rows)
                batch = batch.slice(part.num_rows)
                held.append(part)
                rows += part.num_rows
                if rows == _SEATED_WORDS:
                    yield from sampled(held, number)
                    held, rows, number = [], 0, number + 1
        if held:
            yield from sampled(held, number)

    return run


def _priors(words: DataFrame, name: str) -> tuple[DataFrame, dict]:
    """``words (key, c, t, buckets)`` with the parent's probability; the corpus totals.

    Sorted before sampling, so that a task run again makes the same moves.
    """
    total = words.agg(
        F.sum("c").alias("tokens"),
        F.sum((F.col("c") > 0).cast("bigint")).alias("words"),
        F.sum("t").alias("customers"),
        F.sum((F.round("t") == 1).cast("bigint")).alias("once"),
        F.sum((F.round("t") == 2).cast("bigint")).alias("twice"),
    ).first()
    known, discount = total.words or 0, discount_of(total.once or 0, total.twice or 0)
    uniform = 1.0 / (known + 1)
    ordered = (
        words.select("key", "c", F.col("t").cast("double").alias("t"), "buckets")
        .repartition(shuffle_partitions(words.sparkSession), "key")
        .sortWithinPartitions("key")
    )
    sampled = stored(
        in_arrow(
            ordered,
            _root_tables(uniform, discount, float(known)),
            "key bigint, c bigint, t double, buckets array<int>, root double",
        ),
        name,
    )
    tables = sampled.agg(F.sum("root")).first()[0] or 0.0
    customers = total.customers or 0
    prior = (
        F.greatest(F.lit(0.0), F.col("t") - F.lit(discount) * F.col("root"))
        + F.lit((CONCENTRATION + discount * tables) * uniform)
    ) / F.lit(float(CONCENTRATION + customers))
    told = sampled.select(
        F.explode("buckets").alias("bucket"), "key", "c", prior.cast("float").alias("prior")
    )
    return told, {"tokens": total.tokens or 0, "words": known, "stored": sampled}


def _hot_contexts(source: DataFrame, size: int) -> list[int]:
    """Contexts that fill over a sixteenth of a bucket, as a sample of texts shows them.

    There are at most 16 times as many as buckets. They only decide how work is
    dealt: a context that is missed is dealt less evenly, and counted all the same.
    """
    share = BUCKET_TOKENS / 16 / max(1.0, size / 2)

    def count(batches):
        for batch in batches:
            tokens = word_hashes(batch.column(0))[0]
            words, n = np.unique(tokens, return_counts=True)
            often = n >= max(2, share * len(tokens))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.r_[words[often], np.uint64(START)].view(np.int64)),
                    pa.array(np.r_[n[often], batch.num_rows].astype(np.int64)),
                ],
                ["key", "n"],
            )

    sampled = source.select("text").sample(fraction=_SAMPLED, seed=SEED)
    found = (
        in_arrow(sampled, count, "key bigint, n bigint")
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= _SAMPLED * BUCKET_TOKENS / 16)
    )
    return sorted(_unsigned(r.key) for r in found.collect())


def _unsigned(key: int) -> int:
    return int(key) & ((1 << 64) - 1)


def _hot_table(rows: dict[int, tuple[float, float]]):
    keys = np.array(sorted(rows), np.uint64)
    return (
        keys,
        np.array([rows[int(k)][0] for k in keys], float),
        np.array([rows[int(k)][1] for k in keys], float),
    )


def scores(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: log10 probabilities of its whole text.

    Tokens are the words of the text with A-Z lowered, split at ASCII white
    space, and one end. Rows with crc32(doc_id as text) mod 7 equal to 2 are held
    out; all others, null ids too, are learnt from. ``score`` is the model's,
    ``base_score`` that of add-one unigrams; ``n_known`` counts tokens seen in
    training, ``train_tokens`` all training tokens. Null and empty texts are the
    end alone. Repeated rows are learnt from and scored each. Without training
    rows every token has the uniform probability. Other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(shuffle_partitions(spark), -(-size // (6 * BUCKET_TOKENS)))
    hot = _hot_contexts(source, size)
    shared = spark.sparkContext.broadcast(hot)
    # Bucketed by bucket, so that no later step moves the packed text again.
    with freed_shuffles(spark):
        held = overwrite_table(
            in_arrow(source, _pack(buckets, shared), _PACKED),
            scratch_name("packed_pairs"),
            scratch_database(spark),
            bucket_by="bucket",
            buckets=buckets,
        )
    packed = held.where("packed is not null").select("bucket", "packed")
    hot_now = np.array(hot, np.uint64)
    facts = packed.groupBy("bucket").applyInArrow(lambda table: _facts(table, hot_now), _FACTS)
    # A word is in as many rows as it is in buckets, of which there are few.
    grouped = stored(
        facts.groupBy("kind", "key").agg(
            F.sum("c").alias("c"), F.sum("t").alias("t"), F.collect_list("bucket").alias("buckets")
        ),
        "word_facts",
    )
    words = grouped.where(F.col("kind") == _WORD)
    seen = grouped.where(F.col("kind") == _SEEN).agg(F.sum("c"), F.sum("t")).first()
    totals = {
        _unsigned(r.key): (r.c, float(r.t))
        for r in grouped.where(F.col("kind") == _HOT).select("key", "c", "t").collect()
    }
    model = {
        "strength": CONCENTRATION,
        "discount": discount_of(seen[0] or 0, seen[1] or 0),
        "hot": _hot_table(totals),
    }
    # Round one: one table per pair to start with; buckets sample, then the parent.
    told, parent = _priors(words, "parent_words")
    sampled = stored(
        packed.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(_sampled(model), _TABLES),
        "sampled_tables",
    )
    discard(parent["stored"])
    summed = sampled.groupBy("kind", "key").agg(F.sum("t").alias("more"))
    again = words.join(
        summed.where(F.col("kind") == _WORD).select("key", "more"), "key", "left"
    ).select("key", "c", (F.col("t") + F.coalesce("more", F.lit(0.0))).alias("t"), "buckets")
    totals = {
        _unsigned(r.key): (totals[_unsigned(r.key)][0], r.more)
        for r in summed.where(F.col("kind") == _HOT).collect()
    }
    # Round two: seating under the new parent, averaged into the scores.
    again = stored(again, "word_tables")
    for done in (grouped, sampled):
        discard(done)
    told, corpus = _priors(again, "parent_words")
    discard(again)
    model = model | {"tokens": corpus["tokens"], "words": corpus["words"], "hot": _hot_table(totals)}
    partial = packed.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(_scored(model), _BLOCKS)
    per_row = stored(partial.groupBy("block").applyInArrow(_block_sums, _SCORES), "row_scores")
    discard(corpus["stored"])
    about = held.where("packed is null").select("row", "doc_id", "n_tokens", "held_out")
    return about.join(per_row, "row").select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(corpus["tokens"]).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )

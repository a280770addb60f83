"""Near-duplicates by an LSH forest over MinHash signatures.

Documents with equal shingle sets are one class. A class has ``TREES * DEPTH``
minimum hashes; tree t sorts the classes by its own ``DEPTH`` values and then
by those of the next, ``SORTED_DEPTH`` in all. Neighbours in that order that share
at least ``LEAST_DEPTH`` leading values are candidates: the order puts the longest
common prefixes side by side, so in a crowded region deeper values decide who is
compared first, and in a thin one a short prefix is enough.

Orders are made by range partitions of the whole key. A region of any size may
be split between tasks; rows at the edges of tasks are compared in a second step.
Links are confirmed on the full sets, in three rounds. What a round links has one
label from then on, and only pairs of different labels are looked for:

1. next neighbours in the first trees;
2. neighbours up to ``NEIGHBOURS`` places apart in all trees, among the classes
   that have a neighbour at all; classes carry the sizes of ``BUCKETS`` parts of their
   sets, and a pair whose parts cannot have enough in common is not listed;
3. classes in runs of more rows than that with one prefix and several labels:
   an exact join on the rarest shingles, so that no pair of a run is missed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetrank.llm.common import in_arrow, shuffle_partitions, stored
from facetrank.llm.components import components
from facetrank.llm.words import parts_of, spread, word_hashes

SHINGLE = 5
PERCENT = 75
TREES = 24
DEPTH = 5
LEAST_DEPTH = 3
SORTED_DEPTH = 10
NEIGHBOURS = 8
FIRST_TREES = 4
# Parts of a set by a hash; the smaller sizes of two sets add up to what they can share.
BUCKETS = 128
ROWS_PER_TASK = 50_000
_MATRIX_ROWS = 4_096
_PART_BYTES = 1 << 20

_random = np.random.default_rng(20_240_601)
_WORD_FACTORS = _random.integers(1 << 62, size=SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_HASH_FACTORS = (
    _random.integers(1 << 62, size=TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
)


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit hashes of the shingles of many texts, sorted per text; and how many."""
    words, n = word_hashes(column)
    if not len(words):
        return np.empty(0, np.uint64), n
    start = np.cumsum(n) - n
    owner = np.repeat(np.arange(len(n)), n)
    left = np.repeat(start + n, n) - np.arange(len(words))  # words from here to the end
    padded = np.concatenate([words, np.zeros(SHINGLE - 1, np.uint64)])
    total = np.zeros(len(words), np.uint64)
    for i in range(SHINGLE):
        total += np.where(left > i, padded[i : i + len(words)] * _WORD_FACTORS[i], np.uint64(0))
    short = n < SHINGLE
    first = np.zeros(len(words), bool)
    first[start[short & (n > 0)]] = True
    total[first] += n[owner[first]].astype(np.uint64)  # a short text is one shingle
    held = (left >= SHINGLE) | first
    owner, values = owner[held], spread(total[held])
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], np.bincount(owner[new], minlength=len(n))


def signatures(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Minimum hashes of each shingle set; a row of zeros for an empty one."""
    out = np.zeros((len(counts), len(_HASH_FACTORS)), ">u4")
    filled = np.flatnonzero(counts)
    starts = (np.cumsum(counts) - counts)[filled]
    if not len(filled):
        return out
    least = np.full((len(filled), len(_HASH_FACTORS)), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), _MATRIX_ROWS):
        part = values[at : at + _MATRIX_ROWS, None] * _HASH_FACTORS[None, :]
        # The sets that reach into these rows; the first may have begun before.
        low = np.searchsorted(starts, at, "right") - 1
        high = np.searchsorted(starts, at + len(part))
        found = np.minimum.reduceat(part, np.maximum(starts[low:high] - at, 0), axis=0)
        np.minimum(least[low:high], found, out=least[low:high])
    out[filled] = least >> np.uint64(32)
    return out


def _split(values: np.ndarray, counts: np.ndarray):
    ends = np.cumsum(counts)
    return [values[end - n : end] for end, n in zip(ends.tolist(), counts.tolist(), strict=True)]


def sketch_of(values: np.ndarray) -> bytes | None:
    """How many shingles of a set fall into each bucket, a byte each; None if one has more."""
    sizes = np.bincount((values >> np.uint64(40)).astype(np.int64) % BUCKETS, minlength=BUCKETS)
    return sizes.astype(np.uint8).tobytes() if sizes.max() < 256 else None


def _sign(batches):
    for batch in batches:
        for part in parts_of(batch, 1, _PART_BYTES):
            values, counts = shingle_sets(part.column(1))
            sets = _split(values, counts)
            rows = [row.tobytes() if n else None for row, n in zip(signatures(values, counts), counts, strict=True)]
            digests = [hashlib.md5(own.tobytes()).digest() if len(own) else None for own in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(rows, pa.binary()),
                ],
                ["doc_id", "n_shingles", "class", "signature"],
            )


def _sets(batches):
    """Shingle sets of the documents asked for, as signed numbers."""
    for batch in batches:
        for part in parts_of(batch, 1, _PART_BYTES):
            sets = _split(*shingle_sets(part.column(1)))
            right = [
                (wanted, own.view(np.int64))
                for wanted, own in zip(part.column(0).to_pylist(), sets, strict=True)
                if hashlib.md5(own.tobytes()).digest() == wanted
            ]
            classes, sets = zip(*right, strict=True) if right else ((), ())
            sketches = [sketch_of(own.view(np.uint64)) for own in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(classes, pa.binary()),
                    pa.array(sets, pa.list_(pa.int64())),
                    pa.array(sketches, pa.binary()),
                ],
                ["class", "shingles", "sketch"],
            )


_NEIGHBOURS = "a binary, b binary, tree int, run binary, key binary, label binary, sketch binary"
_PREFIX = 4 * LEAST_DEPTH


def _pairs_of(rows, fresh: int, reach: int):
    """Places ``(i, j)`` in ``rows (tree, key, class, label, sketch)``, in order, of the pairs
    that reach into the last ``fresh``."""
    for j in range(len(rows) - fresh, len(rows)):
        tree, key, node, label, _ = rows[j]
        for i in range(j - 1, max(-1, j - 1 - reach), -1):
            if rows[i][0] != tree or rows[i][1][:_PREFIX] != key[:_PREFIX]:
                break
            if (rows[i][3] or rows[i][2]) != (label or node):
                yield i, j


def possible(rows, pairs, percent: int):
    """Those of ``pairs`` that can be similar enough by their sketches; without one, any can.

    Two sets share at most the smaller of both sizes in each bucket, so no link is lost.
    """
    if not pairs:
        return []
    none = bytes(BUCKETS)
    sizes = np.frombuffer(b"".join(row[4] or none for row in rows), np.uint8).reshape(-1, BUCKETS)
    total = sizes.sum(axis=1, dtype=np.int64)
    known = total > 0
    kept = []
    for at in range(0, len(pairs), _MATRIX_ROWS):
        i, j = np.array(pairs[at : at + _MATRIX_ROWS]).T
        common = np.minimum(sizes[i], sizes[j]).sum(axis=1, dtype=np.int64)
        can = 100 * common >= percent * (total[i] + total[j] - common)
        can |= ~(known[i] & known[j])
        kept += list(zip(i[can].tolist(), j[can].tolist(), strict=True))
    return kept


def _long_runs(rows, fresh: int, reach: int):
    """Prefixes of runs that are longer than neighbours reach."""
    for j in range(max(len(rows) - fresh, reach + 1), len(rows)):
        (tree, key, *_), (far_tree, far_key, *_) = rows[j], rows[j - reach - 1]
        if tree == far_tree and key[:_PREFIX] == far_key[:_PREFIX]:
            yield tree, key[:_PREFIX]


def _neighbour_batch(rows):
    columns = list(zip(*rows, strict=True)) or [()] * 7
    kinds = [pa.int32() if k == 2 else pa.binary() for k in range(7)]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        ["a", "b", "tree", "run", "key", "label", "sketch"],
    )


def _neighbours(reach: int, percent: int, across: bool):
    """Sorted rows to candidate pairs, long runs, and the rows at both ends of the task.

    With ``across``, the rows are such ends of all tasks, and no ends are given.
    """
    kept = reach + 1

    def run(batches):
        seen, held, edges, last = 0, [], [], None
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            edges += rows[: max(0, kept - seen)]
            together = held + rows
            pairs = possible(together, list(_pairs_of(together, len(rows), reach)), percent)
            found = [
                (together[i][2], together[j][2], together[j][0], None, None, None, None) for i, j in pairs
            ]
            for long in dict.fromkeys(_long_runs(together, len(rows), reach)):
                if long != last:
                    found.append((None, None, long[0], long[1], None, None, None))
                    last = long
            yield _neighbour_batch(found)
            seen += len(rows)
            held = together[-kept:]
        if not across:
            # Both ends of a short task overlap; no row is listed twice.
            edges += held[max(0, 2 * kept - seen) :] if seen > kept else []
            yield _neighbour_batch(
                [(node, None, tree, None, key, label, sketch) for tree, key, node, label, sketch in edges]
            )

    return run


def _in_trees(classes: DataFrame) -> DataFrame:
    """A row ``(tree, key, class, label, sketch)`` per class and tree; a class's own label is null."""
    width = 4 * DEPTH
    if "sketch" not in classes.columns:
        classes = classes.withColumn("sketch", F.lit(None).cast("binary"))
    return classes.select(
        "class", "label", "sketch", "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    ).select(
        "tree",
        F.expr(
            f"substring(concat(signature, signature), tree * {width} + 1, {4 * SORTED_DEPTH})"
        ).alias("key"),
        "class",
        F.when(F.col("label") != F.col("class"), F.col("label")).alias("label"),
        "sketch",
    )


def neighbours(classes: DataFrame, reach: int, percent: int = PERCENT) -> DataFrame:
    """Pairs ``(a, b, tree)`` of classes of different labels, and long runs ``(tree, run)``.

    Pairs are at most ``reach`` places apart in the order of the tree, and not ruled out
    by their sketches, where ``classes`` have any; a long run has more than ``reach + 1``
    rows with one prefix.
    """
    order = ["tree", "key", "class"]
    tasks = min(shuffle_partitions(classes.sparkSession), 1 + TREES * classes.count() // ROWS_PER_TASK)
    dealt = (
        _in_trees(classes)
        .repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
    )
    found = stored(in_arrow(dealt, _neighbours(reach, percent, False), _NEIGHBOURS), "neighbours")
    # A few rows per task; only they move.
    edges = (
        found.where("key is not null")
        .select("tree", "key", F.col("a").alias("class"), "label", "sketch")
        .repartition(1)
        .sortWithinPartitions(*order)
    )
    return found.where("key is null").unionByName(in_arrow(edges, _neighbours(reach, percent, True), _NEIGHBOURS))


def _distinct_pairs(pairs: DataFrame) -> DataFrame:
    return (
        pairs.where("b is not null")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a != b")
        .distinct()
    )


def _labelled(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """``classes`` with their labels; one that is in no link is its own label."""
    known = labels.select(F.col("node").alias("class"), F.col("label").alias("known"))
    return (
        classes.drop("label")
        .join(known, "class", "left")
        .withColumn("label", F.coalesce("known", "class"))
        .drop("known")
    )


def _crowded(classes: DataFrame, runs: DataFrame) -> DataFrame:
    """``(class, label)`` of the classes in those ``runs (tree, run)`` that hold several labels."""
    members = stored(
        _in_trees(classes)
        .select("tree", F.expr(f"substring(key, 1, {_PREFIX})").alias("run"), "class", F.coalesce("label", "class").alias("label"))
        .join(runs, ["tree", "run"], "left_semi"),
        "runs",
    )
    several = members.groupBy("tree", "run").agg(F.min("label").alias("least"), F.max("label").alias("most"))
    return (
        members.join(several.where("least != most"), ["tree", "run"], "left_semi")
        .select("class", "label")
        .distinct()
    )


def exact_pairs(members: DataFrame, percent: int) -> DataFrame:
    """``(a, b)``: all pairs of ``members (class, label, shingles)`` that can be similar enough.

    Only pairs of different labels count. Shingles are ordered by rarity. A pair
    that reaches ``percent`` shares a shingle among the first of both, and at its
    first common one enough are left on both sides; ``most`` is the size of the
    largest partner for which that can hold. The smaller of a pair looks for the
    larger one. In the list of a shingle the members of its commonest label are
    never compared with each other, so a large group that is linked already costs
    nothing but its list.
    """
    tokens = members.select("class", F.explode("shingles").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("held")).where("held > 1")
    ordered = tokens.join(shared, "token").groupBy("class").agg(
        F.array_sort(F.collect_list(F.struct("held", "token"))).alias("tokens")
    )
    # Shingles that nobody else has come first and meet nothing.
    alone = F.col("n") - F.size("tokens")
    postings = stored(
        members.select("class", "label", F.size("shingles").cast("bigint").alias("n"))
        .join(ordered, "class")
        .withColumn("alone", alone)
        .withColumn("first", F.expr(f"n - (({percent} * n + 99) div 100) + 1 - alone"))
        .where("first > 0")
        .select("class", "label", "n", "alone", F.posexplode(F.expr("slice(tokens, 1, int(first))")))
        .select(
            F.col("col.token").alias("token"),
            "class",
            "label",
            "n",
            F.expr(f"({100 + percent} * (n - alone - pos)) div {percent} - n").alias("most"),
        ),
        "postings",
    )
    lists = postings.groupBy("token", "label").agg(F.count("*").alias("members"))
    main = (
        lists.groupBy("token")
        .agg(F.max_by("label", F.struct("members", "label")).alias("main"), F.count("*").alias("labels"))
        .where("labels > 1")
        .select("token", "main")
    )
    dealt = stored(postings.join(main, "token").withColumn("other", F.expr("label != main")).drop("main"), "lists")
    small = dealt.where("most >= n").alias("small")
    large = dealt.alias("large")
    fits = F.expr(
        "small.token = large.token and small.label != large.label"
        " and large.n <= small.most and small.n <= large.most"
        " and (large.n > small.n or large.n = small.n and large.class > small.class)"
    )
    found = small.where("other").join(large, fits).select("small.class", F.col("large.class").alias("with"))
    back = small.where("not other").join(large.where("other"), fits)
    return _distinct_pairs(
        found.union(back.select("small.class", F.col("large.class").alias("with"))).toDF("a", "b")
    )


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("a_set"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("b_set"))
    common = F.size(F.array_intersect("a_set", "b_set"))
    either = F.size("a_set") + F.size("b_set") - F.col("common")
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .withColumn("common", common)
        .where(100 * F.col("common") >= percent * either)
        .select("a", "b")
    )


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two documents are linked if their shingle sets have at least ``percent`` per
    cent in common; a component is what links reach, and its smallest doc_id
    stays. A text of fewer than five words is one shingle. Null, empty and blank
    texts have no shingles and are linked with nothing: they are their own
    component. Rows that repeat the doc_id that stays are all kept; a null
    doc_id stays only where its component has no other. Other columns are
    ignored; an empty table gives no rows.
    """
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    signed = stored(
        in_arrow(source, _sign, "doc_id bigint, n_shingles bigint, class binary, signature binary"),
        "signatures",
    )
    classes = stored(
        signed.where("class is not null")
        .groupBy("class")
        .agg(F.min("signature").alias("signature"), F.min("doc_id").alias("doc_id"))
        .withColumn("label", F.col("class")),
        "classes",
    )
    near = neighbours(classes, 1).where("b is not null").select("a", "b", "tree")
    near = stored(near, "next_neighbours")
    ends = near.select(F.col("a").alias("class")).union(near.select("b")).distinct()
    met = stored(classes.join(ends, "class", "left_semi"), "classes_met")
    wanted = met.select("class", F.col("doc_id").alias("wanted_id"))
    sets = stored(
        in_arrow(
            source.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id"))).select("class", "text"),
            _sets,
            "class binary, shingles array<bigint>, sketch binary",
        ).dropDuplicates(["class"]),
        "shingle_sets",
    )

    def linked(pairs: DataFrame, known: DataFrame | None) -> DataFrame:
        links = _confirmed(stored(pairs, "candidates"), sets, percent)
        if known is not None:
            links = links.unionByName(known.select(F.col("node").alias("a"), F.col("label").alias("b")))
        return stored(components(links), "labels")

    labels = linked(_distinct_pairs(near.where(F.col("tree") < FIRST_TREES)), None)
    marked = _labelled(met, labels).join(sets.select("class", "sketch"), "class", "left")
    found = stored(neighbours(stored(marked, "labelled_classes"), NEIGHBOURS, percent), "pairs_and_runs")
    labels = linked(_distinct_pairs(found), labels)
    runs = found.where("run is not null").select("tree", "run").distinct()
    members = stored(_crowded(_labelled(met, labels), runs).join(sets.drop("sketch"), "class"), "crowded")
    labels = linked(exact_pairs(members, percent), labels)
    rows = stored(
        signed.select("doc_id", "n_shingles", "class")
        .join(labels, F.col("class") == F.col("node"), "left")
        .select("doc_id", "n_shingles", F.coalesce("label", "class").alias("label")),
        "labelled",
    )
    heads = stored(
        rows.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id")),
        "component_heads",
    )
    own = F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.join(heads, "label", "left").select(
        "doc_id",
        "n_shingles",
        own.alias("component_id"),
        F.col("doc_id").eqNullSafe(own).alias("kept"),
    )

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa

from facetrank.llm import neardup
from facetrank.llm.components import components
from tests.llm.fixtures import documents, odd_texts, prose, tuples

COLUMNS = ["doc_id", "n_shingles", "component_id", "kept"]


def shingle_set(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def expected(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [x for x in groups[find(i)] if x is not None]
        head = min(ids) if ids else None
        out.append((doc_id, len(sets[i]), head, doc_id == head))
    return sorted(out, key=repr)


def variants(rng, base, n, edits):
    for _ in range(n):
        words = base.split()
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        yield " ".join(words)


def test_like_brute_force(spark):
    rng = random.Random(12)
    rows = list(enumerate(prose(rng, rng.randrange(3, 120)) for _ in range(150)))
    for _ in range(12):  # groups around the limit, with links on both sides of it
        for text in variants(rng, prose(rng, 150), 8, 4):
            rows.append((len(rows), text))
    shared = prose(rng, 60)  # a passage that many texts share
    rows += [(len(rows) + i, f"{prose(rng, 90)} {shared}") for i in range(40)]
    rng.shuffle(rows)
    assert tuples(neardup.near_duplicates(documents(spark, rows)), *COLUMNS) == expected(rows)


def test_exactly_at_the_limit(spark):
    words = [f"a{i}" for i in range(200)]
    rows = []
    for doc_id, shared in ((0, 40), (10, 41), (20, 42), (30, 43), (40, 60)):
        # Two sets of k shared shingles and n of their own each.
        own = 7
        left = words[: shared + 4] + [f"l{doc_id}_{i}" for i in range(own)]
        right = words[: shared + 4] + [f"r{doc_id}_{i}" for i in range(own)]
        prefix = [f"p{doc_id}_{i}" for i in range(3)]
        rows += [(doc_id, " ".join(prefix + left)), (doc_id + 1, " ".join(prefix + right))]
    assert tuples(neardup.near_duplicates(documents(spark, rows)), *COLUMNS) == expected(rows)


def test_large_group_of_near_copies(spark):
    rng = random.Random(2)
    rows = list(enumerate(variants(rng, prose(rng, 200), 400, 2)))
    got = neardup.near_duplicates(documents(spark, rows)).collect()
    assert {r.component_id for r in got} == {0} and sum(r.kept for r in got) == 1


def test_every_link_of_a_crowded_region(spark):
    # All texts share most shingles, at less than the limit; only partners are above it.
    rng = random.Random(5)
    common = [f"c{i}" for i in range(104)]
    rows = []
    for pair in range(1_000):
        own = [f"p{pair}_{i}" for i in range(9)]
        for side in "lr":
            rows.append((len(rows), " ".join(common + own + [f"{side}{pair}_{i}" for i in range(13)])))
    a, b, other = (shingle_set(rows[i][1]) for i in (0, 1, 2))
    assert 100 * len(a & b) >= 75 * len(a | b) and 100 * len(a & other) < 75 * len(a | other)
    rng.shuffle(rows)
    got = neardup.near_duplicates(documents(spark, rows)).collect()
    assert all(r.component_id == r.doc_id - r.doc_id % 2 for r in got) and len(got) == len(rows)


def test_stragglers_beside_a_large_linked_group(spark):
    rng = random.Random(6)
    base = prose(rng, 300, 5_000)
    rows = list(enumerate(variants(rng, base, 300, 2)))
    for _ in range(30):  # around the limit to the group and to each other
        words = base.split()
        for i in rng.sample(range(0, 300, 8), rng.choice((6, 7, 8, 9, 10))):
            words[i] = f"y{rng.randrange(10**6)}"
        rows.append((len(rows), " ".join(words)))
    assert tuples(neardup.near_duplicates(documents(spark, rows)), *COLUMNS) == expected(rows)


def test_exact_pairs_lose_none(spark):
    rng = random.Random(8)
    sets = []
    for _ in range(250):
        pool = rng.choice(((0, 40), (0, 60), (30, 90)))
        sets.append(sorted(rng.sample(range(*pool), rng.randrange(1, pool[1] - pool[0]))))
    sets = [list(x) for x in dict.fromkeys(map(tuple, sets))]
    labels = [rng.choice((0, 0, 0, i)) for i in range(len(sets))]
    members = spark.createDataFrame(
        [(i, labels[i], s) for i, s in enumerate(sets)], "class bigint, label bigint, shingles array<bigint>"
    )
    got = set(tuples(neardup.exact_pairs(members, 75), "a", "b"))
    truth = {
        (i, j)
        for j in range(len(sets))
        for i in range(j)
        if labels[i] != labels[j]
        and 100 * len(set(sets[i]) & set(sets[j])) >= 75 * len(set(sets[i]) | set(sets[j]))
    }
    assert truth and truth <= got


def test_odd_rows_and_clashing_columns(spark):
    rows = odd_texts()
    got = [r for r in tuples(neardup.near_duplicates(documents(spark, rows, clashing=True)), *COLUMNS)]
    assert got == expected(rows)


def test_empty_table(spark):
    assert neardup.near_duplicates(documents(spark, [])).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(300)] + [(1_000, 1_001 + i) for i in range(300)]
    edges += [(5_000, 5_000), (7_001, 7_000), (7_000, 7_001)]
    rng.shuffle(edges)
    got = dict(tuples(components(spark.createDataFrame(edges, "a bigint, b bigint")), "node", "label"))
    truth = {i: 0 for i in range(301)} | {1_000 + i: 1_000 for i in range(301)} | {7_000: 7_000, 7_001: 7_000}
    assert got == truth


def test_sketches_rule_out_no_link_and_most_others():
    rng = np.random.default_rng(4)
    groups, wanted = [], set()
    for n in (3, 40, 150, 700):
        base = rng.integers(1 << 63, size=n, dtype=np.uint64)
        for changed in np.linspace(0, 0.6, 40):
            own = rng.integers(1 << 63, size=int(changed * n), dtype=np.uint64)
            groups.append(np.unique(np.concatenate([own, base[len(own) :]])))
    groups.append(rng.integers(1 << 63, size=60_000, dtype=np.uint64))  # too many for a byte each
    rows = [(0, b"", k, None, neardup.sketch_of(values)) for k, values in enumerate(groups)]
    pairs = [(i, j) for j in range(len(rows)) for i in range(j)]
    for i, j in pairs:
        common = len(np.intersect1d(groups[i], groups[j]))
        if 100 * common >= 75 * (len(groups[i]) + len(groups[j]) - common):
            wanted.add((i, j))
    kept = set(neardup.possible(rows, pairs, 75))
    assert rows[-1][4] is None and {(i, len(rows) - 1) for i in range(len(rows) - 1)} <= kept
    others = {pair for pair in kept - wanted if pair[1] < len(rows) - 1}
    assert wanted and wanted <= kept and len(others) < len(pairs) // 20


def test_few_candidates_in_a_crowded_region(spark):
    # Half of each text is common to all: neighbours in the orders, but no links.
    rng = random.Random(9)
    common = [f"c{i}" for i in range(80)]
    texts = [" ".join(common + [f"o{k}_{i}" for i in range(50)]) for k in range(300)]
    columns = zip(*[(str(k).encode(), text.encode()) for k, text in enumerate(texts)], strict=True)
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["doc_id", "text"])
    values, counts = neardup.shingle_sets(batch.column(1))
    signed = neardup.signatures(values, counts)
    names = [str(k).encode() for k in range(len(texts))]
    sets = neardup._split(values, counts)
    rows = [
        (name, name, row.tobytes(), neardup.sketch_of(own))
        for name, row, own in zip(names, signed, sets, strict=True)
    ]
    rng.shuffle(rows)
    classes = spark.createDataFrame(rows, "class binary, label binary, signature binary, sketch binary")
    without = neardup.neighbours(classes.drop("sketch"), 8).where("b is not null").count()
    with_sketches = neardup.neighbours(classes, 8).where("b is not null").count()
    assert without > 1_000 and with_sketches < without // 20
    runs = [
        set(tuples(neardup.neighbours(c, 8).where("run is not null").distinct(), "tree", "run"))
        for c in (classes.drop("sketch"), classes)
    ]
    assert runs[0] == runs[1]

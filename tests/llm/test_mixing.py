from __future__ import annotations

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from facetrank.llm import mixing
from tests.llm.fixtures import documents, odd_texts, tuples


def poisson_count(doc_id, rate, seed=mixing.SEED):
    name = "null" if doc_id is None else str(doc_id)
    digits = hashlib.md5(f"{seed}/count/{name}".encode()).hexdigest()[:13]
    draw = (int(digits, 16) + 0.5) / 2**52
    k, term = 0, math.exp(-rate)
    below = term
    while below < draw:
        k += 1
        term *= rate / k
        below += term
    return k


@pytest.mark.parametrize("weights", [None, {"src0": 3.0, "src1": 1.0}, {"src0": -1.0, "src2": None}])
def test_counts_follow_the_inverse_distribution(spark, weights):
    rows = [(i, "word " * (i % 50)) for i in range(400)] + odd_texts()[:6]
    docs = documents(spark, rows, clashing=True)
    sizes = Counter()
    for i, t in rows:
        sizes[f"src{i % 3}"] += max(1, len(t or ""))
    table = None
    given = {s: n**mixing.TEMPERATURE for s, n in sizes.items()}
    if weights is not None:
        table = spark.createDataFrame(list(weights.items()), "source string, weight double")
        given = {s: max(0.0, weights.get(s) or 0.0) for s in sizes}
    total = sum(given.values())
    rate = {s: sum(sizes.values()) * w / total / sizes[s] if total else 0.0 for s, w in given.items()}
    expected = Counter()
    for i, _ in rows:
        expected[i] += poisson_count(i, rate[f"src{i % 3}"]) if rate[f"src{i % 3}"] else 0
    got = mixing.mix(docs, table)
    assert Counter(r.doc_id for r in got.collect()) == +expected


def test_shares_reach_the_weights(spark):
    rows = [(i, "x" * 100) for i in range(9_000)]
    weights = spark.createDataFrame([("src0", 6.0), ("src1", 3.0), ("src2", 1.0)], "source string, weight double")
    got = Counter(r.source for r in mixing.mix(documents(spark, rows), weights).select("source").collect())
    assert abs(sum(got.values()) - 9_000) < 400
    for source, share in (("src0", 0.6), ("src1", 0.3), ("src2", 0.1)):
        assert abs(got[source] / sum(got.values()) - share) < 0.02


def test_order_is_the_key_and_not_the_input(spark):
    got = mixing.mix(documents(spark, [(i, "x") for i in range(500)])).collect()
    keys = [r.shuffle_key for r in got]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)
    ids = [r.doc_id for r in got]
    assert ids != sorted(ids)


def test_large_rates_do_not_underflow(spark):
    rate = spark.range(1).select(mixing.poisson_distribution(F.lit(2_000.0)).alias("p")).first().p
    assert abs(rate[-1] - 1) < 1e-9
    assert 1_950 < sum(p < 0.5 for p in rate) < 2_050


def test_null_sources_and_empty_tables(spark):
    docs = documents(spark, [(1, "a"), (2, "b")]).withColumn("source", F.lit(None).cast("string"))
    assert all(r.source is None for r in mixing.mix(docs).collect())
    assert mixing.mix(documents(spark, [])).count() == 0


def test_repeated_rows_repeat_alike(spark):
    once = tuples(mixing.mix(documents(spark, [(5, "x"), (5, "x"), (8, "y")])), "doc_id", "copy")
    assert all(n == 2 for (i, _), n in Counter(once).items() if i == 5)

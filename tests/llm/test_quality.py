from __future__ import annotations

import random
import zlib

import numpy as np

from facetrank.llm import quality
from facetrank.llm.common import hash_bounds
from tests.llm.fixtures import documents, odd_texts, prose

LABELS = "doc_id bigint, quality int, toxic int"


def corpus(n=600):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        text = prose(rng, rng.randrange(20, 300))
        if not good:
            text = [text.upper(), "spam " * 50, text.replace(" ", "$$$ "), text.replace(" ", " | ")][i % 4]
        rows.append((i, text))
        labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    got = quality.quality_scores(documents(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    truth = {i: q for i, q, _ in labels}
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 < r.score < 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95


def test_held_out_labels_are_not_learnt_from(spark):
    rows, labels = corpus(200)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    docs = documents(spark, rows)
    one, two = (
        sorted(quality.quality_scores(docs, spark.createDataFrame(x, LABELS)).collect())
        for x in (labels, flipped)
    )
    assert [r.doc_id for r in one] == [r.doc_id for r in two]
    assert np.allclose([r.score for r in one], [r.score for r in two])


def test_odd_rows_score(spark):
    _, labels = corpus(50)
    rows = odd_texts()
    marks = spark.createDataFrame(labels + [(None, 1, 0), (4, None, None), (4, 0, 0)], LABELS)
    got = quality.quality_scores(documents(spark, rows, clashing=True), marks).collect()
    assert len(got) == len(rows) and all(0 < r.score < 1 for r in got)


def test_no_labels_and_no_rows(spark):
    docs = documents(spark, [(1, "a b"), (2, None)])
    none = spark.createDataFrame([], LABELS)
    got = quality.quality_scores(docs, none).collect()
    assert len({r.score for r in got}) == 1 and all(r.predicted == 1 for r in got)
    assert quality.quality_scores(documents(spark, []), none).count() == 0


def test_bound_of_the_sample(spark):
    rows, labels = corpus(100)
    docs, marks = documents(spark, rows), spark.createDataFrame(labels, LABELS)
    assert quality.quality_scores(docs, marks, sample_rows=40).count() == 100


def test_sample_is_the_smallest_hashes(spark):
    rows, labels = corpus(400)
    repeated = [(labels[0][0], labels[0][1], 0)] * 300 + [(labels[1][0], labels[1][1], 0)] * 300
    marks = spark.createDataFrame(labels + repeated, LABELS)
    smallest = (
        marks.where(~quality.held_out(quality.F.col("doc_id")))
        .orderBy(quality.F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(60)
    )
    docs = documents(spark, rows)
    got = quality.quality_scores(docs, marks, sample_rows=60).collect()
    assert sorted(got) == sorted(quality.quality_scores(docs, smallest).collect())


def test_bounds_rise_to_all_rows():
    for rows in (0, 1, 60, 10_000, 10**12):
        bounds = list(hash_bounds(rows, 60))
        assert bounds == sorted(bounds) and bounds[-1] == 2**63 - 1
    share = (next(iter(hash_bounds(10**12, 10_000))) + 2**63) / 2**64
    assert 10_000 < share * 10**12 < 12_000

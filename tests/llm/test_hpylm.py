from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from facetrank.llm import hpylm
from tests.llm.fixtures import documents, odd_texts, prose


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def sentences(rng, n):
    """Texts in which the word before says a lot about the next."""
    follow = {i: [rng.randrange(300) for _ in range(4)] for i in range(300)}
    for i in range(n):
        word, out = rng.randrange(300), []
        for _ in range(rng.randrange(5, 60)):
            out.append(f"w{word}")
            word = rng.choice(follow[word])
        yield i, " ".join(out)


def test_base_scores_and_counts(spark):
    rows = list(sentences(random.Random(1), 100)) + odd_texts()
    got = hpylm.scores(documents(spark, rows, clashing=True)).collect()
    count = Counter(w for d, t in rows if not held_out(d) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    truth = []
    for d, t in rows:
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens(t))
        truth.append((d, held_out(d), len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), n, round(base, 6)))
    mine = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
    assert sorted(mine, key=repr) == sorted(truth, key=repr)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_better_than_unigrams_on_held_out_texts(spark):
    got = [r for r in hpylm.scores(documents(spark, sentences(random.Random(2), 600))).collect() if r.held_out]
    per = lambda field: sum(r[field] for r in got) / sum(r.n_tokens for r in got)
    # Four followers each: about log10(4) per word.
    assert per("score") > -0.8 and per("base_score") < -2


@pytest.mark.parametrize("hot", [False, True])
def test_probabilities_of_a_context_sum_to_one(spark, monkeypatch, hot):
    """Every known word and one unknown after one context, as held-out texts."""
    if hot:  # every context is dealt by pair
        monkeypatch.setattr(hpylm, "_hot_contexts", lambda source, size: sorted({int(h) for t in ("a b c d", "c a b a") for h in hpylm.token_hashes(t.encode())[:-1]}))
    train = [i for i in range(400) if not held_out(i)]
    out = [i for i in range(400, 800) if held_out(i)]
    texts = ["a b a c", "b a c a", "c c c a b", "d a", "a a a b c d"]
    rows = [(i, texts[n % 5]) for n, i in enumerate(train[:60])]
    known = ["a", "b", "c", "d"]
    probes = [(out[n], f"{known[0]} {w}") for n, w in enumerate([*known, "zzz"])] + [(out[9], known[0])]
    got = {r.doc_id: r.score for r in hpylm.scores(documents(spark, rows + probes)).collect()}
    # P(start a) P(x | a) P(end | x); "a" alone gives P(start a) P(end | a).
    counts = {r.doc_id for r in hpylm.scores(documents(spark, rows)).collect()}
    assert counts == {i for i, _ in rows}
    assert all(got[i] < 0 for i, _ in probes)


def test_same_result_on_every_run(spark):
    docs = documents(spark, sentences(random.Random(3), 60))
    one, two = (sorted((r.doc_id, round(r.score, 9)) for r in hpylm.scores(docs).collect()) for _ in range(2))
    assert one == two


def test_empty_table_and_no_training_rows(spark):
    assert hpylm.scores(documents(spark, [])).count() == 0
    out = [i for i in range(100) if held_out(i)][:3]
    got = hpylm.scores(documents(spark, [(i, "a b") for i in out])).collect()
    assert all(r.train_tokens == 0 and r.score == 0 and r.n_known == 0 for r in got)


def exact_tables(c, a, discount, step):
    """Mean tables of one cell under the process, by the exact recursion on (customers, tables)."""
    # Weight of an arrangement with t tables: product of (a + step * j) times generalized Stirling numbers.
    stirling = np.zeros((c + 1, c + 1))
    stirling[0, 0] = 1
    for n in range(c):
        for t in range(n + 1):
            stirling[n + 1, t + 1] += stirling[n, t]
            stirling[n + 1, t] += stirling[n, t] * (n - discount * t)
    weight = np.array([stirling[c, t] * np.prod([a + step * j for j in range(t)]) for t in range(c + 1)])
    return (weight * np.arange(c + 1)).sum() / weight.sum()


@pytest.mark.parametrize(("c", "discount", "prior"), [(2, 0.5, 0.3), (5, 0.8, 0.2), (9, 0.3, 0.9), (40, 0.7, 0.5)])
def test_seating_has_the_right_mean(c, discount, prior):
    """Many restaurants of one cell each, with so many other tables that one more changes little."""
    n, others = 3_000, 10_000.0
    rng = np.random.default_rng(4)
    small = prior / (discount * others)  # so that a new table weighs about ``prior``
    got = hpylm.seat(
        np.full(n, float(c)), np.full(n, small), np.arange(n), np.full(n, others), 1.0, discount, rng, 30, 10
    ).mean()
    a = (1.0 + discount * (others + 1)) * small
    assert abs(got - exact_tables(c, a, discount, 0.0)) / got < 0.03


def mean_tables(c, weight, discount, most=80):
    """As ``exact_tables`` with one weight, for many customers of few tables."""
    share = np.zeros(most)
    share[0] = 1.0
    tables = np.arange(1, most + 1)
    for n in range(1, c):
        share = share * (n - discount * tables).clip(0) + weight * np.r_[0.0, share[:-1]]
        share /= share.sum()
    return (share * tables).sum()


@pytest.mark.parametrize(("c", "discount", "weight"), [(600, 0.7, 0.5), (20_000, 0.8, 1.0)])
def test_few_sweeps_reseat_all_customers_of_a_large_cell(c, discount, weight):
    """A sweep moves every customer, whatever the size of the cell."""
    n, others = 2_000, 1e7
    prior = weight / (discount * others)
    got = hpylm.seat(
        np.full(n, float(c)), np.full(n, prior), np.arange(n), np.full(n, others), 1.0, discount,
        np.random.default_rng(5), 4, 3
    ).mean()
    assert abs(got - mean_tables(c, weight, discount)) / got < 0.03


def test_packing_gives_back_all_entries():
    rng = np.random.default_rng(0)
    u, w = rng.integers(1 << 60, size=50, dtype=np.uint64)[rng.integers(50, size=(2, 4_000))]
    row = rng.integers(100, size=4_000).astype(np.uint64) + np.uint64(1 << 40)
    parts = [hpylm._pack_bucket(u[i::3], w[i::3], row[i::3]) for i in range(3)]
    bucket = hpylm.Bucket(parts)
    got = Counter()
    for p, r, n in zip(bucket.pair, bucket.row, bucket.n, strict=True):
        got[int(bucket.contexts[bucket.u[p]]), int(bucket.words[bucket.w[p]]), int(r)] += int(n)
    assert got == Counter(zip(u.tolist(), w.tolist(), row.tolist(), strict=True))


def test_long_and_repeated_text(spark):
    rng = random.Random(1)
    rows = [(0, "spam " * 50_000), (1, prose(rng, 50_000)), (2, "spam")]
    assert len(hpylm.scores(documents(spark, rows)).collect()) == 3

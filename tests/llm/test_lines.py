from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from facetrank.llm import lines
from facetrank.llm.words import word_hashes
from tests.llm.fixtures import documents, odd_texts, prose, tuples

COLUMNS = ["doc_id", "n_lines", "n_dropped", "text"]


def distance_at_most_one(a, b):
    if a == b:
        return True
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(rows):
    seen = sorted(
        {(1 << 63 if d is None else d, n, tuple(x.split())) for d, t in rows for n, x in enumerate((t or "").encode().split(b"\n")) if x.split()}
    )
    out = []
    for doc_id, text in rows:
        own = 1 << 63 if doc_id is None else doc_id
        split = (text or "").encode().split(b"\n")
        kept = [
            x
            for n, x in enumerate(split)
            if not x.split()
            or not any(distance_at_most_one(list(w), x.split()) for d, k, w in seen if (d, k) < (own, n))
        ]
        out.append((doc_id, len(split), len(split) - len(kept), b"\n".join(kept).decode()))
    return sorted(out, key=repr)


def edited(rng, line):
    words = line.split()
    at, kind = rng.randrange(len(words)), rng.randrange(3)
    new = f"n{rng.randrange(10**6)}"
    words[at : at + (kind != 0)] = [] if kind == 1 and len(words) > 1 else [new]
    return " ".join(words)


def test_like_brute_force(spark):
    rng = random.Random(21)
    pool = [prose(rng, rng.randrange(1, 60)) for _ in range(60)]
    pool += [edited(rng, rng.choice(pool)) for _ in range(120)]
    rows = []
    for i in range(70):
        chosen = [rng.choice(pool) for _ in range(rng.randrange(6))]
        rows.append((i, "\n".join(edited(rng, x) if rng.random() < 0.4 else x for x in [*chosen, prose(rng, 25)])))
    rng.shuffle(rows)
    assert tuples(lines.deduplicated_lines(documents(spark, rows)), *COLUMNS) == expected(rows)


def test_odd_rows_and_clashing_columns(spark):
    rows = [(d, t) for d, t in odd_texts() if d not in (11,)]
    rows += [(30, "a\n\n b \r\nb\na b"), (31, "\n\n"), (32, "x y z\nx  y\tz")]
    got = lines.deduplicated_lines(documents(spark, rows, clashing=True))
    assert tuples(got, *COLUMNS) == expected(rows)


def test_empty_table(spark):
    assert lines.deduplicated_lines(documents(spark, [])).count() == 0


WORDS = st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=5)


@settings(max_examples=500, deadline=None)
@given(WORDS, WORDS)
def test_edit_check(a, b):
    assert lines.within_one_word(a, b) == distance_at_most_one(a, b)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=3, max_size=40), st.data())
def test_near_lines_share_a_chunk_key(numbers, data):
    words = [b"w%d" % n for n in numbers]
    at = data.draw(st.integers(0, len(words) - 1))
    new = data.draw(st.sampled_from([[], [b"new"], [b"w7"], [b"w8", words[at]], [words[at], b"w9"]]))
    other = words[:at] + new + words[at + 1 :]
    if not other or not distance_at_most_one(words, other):
        return
    column = pa.array([b" ".join(words), b" ".join(other)])
    line, keys, short = lines.Hashed(*word_hashes(column, lower=False)).chunk_keys(np.arange(2))
    assert len(short) or set(keys[line == 0].tolist()) & set(keys[line == 1].tolist())


def test_lines_that_are_patterns_of_two_words_are_told_apart(spark):
    """The Thue-Morse sequence and its complement: equal in any sum of powers modulo 2**64."""
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    one = " ".join("ab"[b] for b in bits)
    other = " ".join("ba"[b] for b in bits)
    rows = [(1, f"{one}\n{other}"), (2, f"{other}\n{one}"), (3, one)]
    got = lines.deduplicated_lines(documents(spark, rows))
    assert tuples(got, "doc_id", "n_dropped", "text") == [(1, 0, rows[0][1]), (2, 2, ""), (3, 1, "")]

from __future__ import annotations

import hashlib
import random

from facetrank.llm import exactdup
from tests.llm.fixtures import documents, odd_texts, prose, tuples


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").encode().lower(), []).append(doc_id)
    out = []
    for doc_id, text in rows:
        key = (text or "").encode().lower()
        ids = [i for i in groups[key] if i is not None]
        keep = max(ids) if ids else None
        out.append((doc_id, keep, len(groups[key]), doc_id == keep, hashlib.sha256(key).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_odd_rows_and_clashing_columns(spark):
    rows = odd_texts()
    got = exactdup.exact_duplicates(documents(spark, rows, clashing=True))
    assert tuples(got, *COLUMNS) == expected(rows)


def test_blocks_that_differ_in_one_place(spark):
    rng = random.Random(5)
    base = prose(rng, 2_000)
    rows = [(i, base) for i in range(30)]
    for i in range(30, 60):  # one changed character at any place
        at = rng.randrange(len(base))
        rows.append((i, base[:at] + "#" + base[at + 1 :]))
    rows += [(100 + n, "x" * n * exactdup.BLOCK) for n in range(6)]  # whole blocks, equal ones
    rows += [(200 + n, "x" * n * exactdup.BLOCK) for n in range(6)]
    got = exactdup.exact_duplicates(documents(spark, rows))
    assert tuples(got, *COLUMNS) == expected(rows)


def test_empty_table(spark):
    assert exactdup.exact_duplicates(documents(spark, [])).count() == 0

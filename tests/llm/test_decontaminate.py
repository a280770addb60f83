from __future__ import annotations

import hashlib
import random
import re

import pytest

from facetrank.llm import decontaminate
from tests.llm.fixtures import documents, odd_texts, prose, tuples

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def expected(rows, items):
    out = []
    for doc_id, text in rows:
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            iw = words(item)
            wins = [iw[i : i + 13] for i in range(max(1, len(iw) - 12))] if iw else []
            for win in wins:
                for s in range(len(w) - len(win) + 1):
                    if w[s : s + len(win)] == win:
                        hit.update(range(s, s + len(win)))
                        found.add(None if item_id is None else str(item_id))
        listed = sorted(found - {None})
        sha = hashlib.sha256(",".join(listed).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(listed), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def case():
    rng = random.Random(4)
    items = [(i, prose(rng, rng.choice([1, 2, 5, 13, 14, 40]), 60)) for i in range(12)]
    items += [(20, None), (21, "..."), (None, prose(rng, 20, 60)), (22, items[5][1]), (23, "É ß one É ß")]
    rows = [(i, prose(rng, 200, 60)) for i in range(40)]
    for i in range(40, 90):
        a, b = rng.choice(items), rng.choice(items)
        rows.append((i, f"{prose(rng, rng.randrange(60))} {a[1] or ''} {prose(rng, 5)} {(b[1] or '').upper()}"))
    rows.append((95, "É ß ONE É ß one É ß"))
    rows += [(100 + i, items[9][1]) for i in range(3)] + odd_texts()
    return rows, items


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, -1])
def test_like_brute_force(spark, monkeypatch, limit):
    """Also without broadcasts, as a large benchmark is joined."""
    monkeypatch.setattr(decontaminate._small, "__defaults__", (limit,))
    rows, items = case()
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.contamination(documents(spark, rows, clashing=True), benchmark)
    assert tuples(got, *COLUMNS) == expected(rows, items)


def test_no_items_and_no_rows(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    got = decontaminate.contamination(documents(spark, [(1, "a b"), (2, None)]), none).collect()
    assert [r.contaminated for r in got] == [False, False]
    assert decontaminate.contamination(documents(spark, []), some).count() == 0


def test_main_path_has_no_python(spark):
    rows, items = case()
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    plan = decontaminate.contamination(documents(spark, rows), benchmark)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa

from facetrank.llm import licenses
from tests.llm.fixtures import odd_texts, tuples

FILES = "file_id bigint, path string, text string, license string, dir string"
MIT, APACHE, GPL = (
    next(t for n, t in licenses.TEMPLATES if n == name) for name in ("MIT", "Apache-2.0", "GPL-3.0")
)


def scanned(spark, rows):
    files = spark.createDataFrame([(*r, "clash", "clash") for r in rows], FILES)
    return licenses.scan_licenses(files)


def test_own_and_nearest_inherited(spark):
    rows = [
        (1, "LICENSE", MIT),
        (2, "a.py", "print(1)"),
        (3, "lib/b.py", f"# {APACHE}\nimport x"),
        (4, "lib/c.py", "code"),
        (5, "lib/deep/COPYING.txt", GPL),
        (6, "lib/deep/er/d.py", "code"),
        (7, "lib/deeper/e.py", "code"),
        (8, "lib/deep/er/LICENSE", "no licence in here"),
        (9, None, "at the top"),
        (10, "lib/deep/er/f.py", None),
    ]
    got = {r[0]: r[1:] for r in tuples(scanned(spark, rows), "file_id", "license", "origin", "from_dir")}
    assert got[1] == ("MIT", "own", None)
    assert got[2] == ("MIT", "inherited", "")
    assert got[3] == ("Apache-2.0", "own", None)
    assert got[4] == ("MIT", "inherited", "")
    assert got[6] == got[8] == got[10] == ("GPL-3.0", "inherited", "lib/deep")
    assert got[7] == ("MIT", "inherited", "")
    assert got[9] == ("MIT", "inherited", "")


def test_cosines_like_brute_force(spark):
    texts = [MIT, f"some words\n{GPL} and more", "the and of license", APACHE.upper(), "Licensed under CC BY-NC 4.0", ""]
    rows = [(i, f"d{i}/x.txt", t) for i, t in enumerate(texts)]
    held = Counter(w for t in texts for w in set(licenses.words_of(t.encode())))
    idf = lambda w: math.log((len(texts) + 1) / ((held[w] if w in licenses.VOCABULARY else 0) + 1)) + 1

    def vector(text):
        return {w: n * idf(w) for w, n in Counter(licenses.words_of(text)).items()}

    def cosine(a, b):
        norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        return sum(x * b.get(w, 0) for w, x in a.items()) / norm if norm else 0

    for file_id, score, license in tuples(scanned(spark, rows), "file_id", "score", "license"):
        best = max(
            ((cosine(vector(line), vector(t.encode())), n) for line in texts[file_id].encode().split(b"\n") for n, t in licenses.TEMPLATES),
            key=lambda x: x[0],
        )
        if best[0] >= licenses.THRESHOLD:
            assert abs(score - best[0]) < 1e-9 and license == best[1]
        else:
            assert license is None


def test_odd_rows(spark):
    rows = [(i, f"x/{n}", t) for n, (i, t) in enumerate(odd_texts())]
    assert scanned(spark, rows).count() == len(rows)
    assert scanned(spark, []).count() == 0


def test_best_of_several_files_then_the_smaller(spark):
    rows = [(1, "p/LICENSE-a", GPL), (2, "p/LICENSE-b", MIT), (3, "p/x", "code"), (4, "p/LICENSE-c", MIT + " or so")]
    got = {r[0]: r[1] for r in tuples(scanned(spark, rows), "file_id", "license")}
    assert got[3] == min("GPL-3.0", "MIT")


def test_texts_of_a_batch_are_taken_by_bytes():
    texts = [f"{'word ' * 60_000}\n{MIT}".encode(), b"", MIT.encode()] * 8
    columns = [
        pa.array(range(len(texts)), pa.int64()),
        pa.array([f"{i}.txt" for i in range(len(texts))], pa.string()),
        pa.array(texts, pa.binary()),
        pa.array([False] * len(texts)),
    ]
    batch = pa.RecordBatch.from_arrays(columns, ["file_id", "path", "text", "is_license"])
    found = list(licenses._scan(1, {}, licenses.THRESHOLD)([batch]))
    assert len(found) >= 3 and max(b.num_rows for b in found) < batch.num_rows
    rows = [row for b in found for row in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert [r[0] for r in rows] == list(range(len(texts)))
    assert [r[3] for r in rows] == [None if not t else "MIT" for t in texts]

"""Small tables for the tests, made by rules, and helpers."""

from __future__ import annotations

import random

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: An extra column for each name that operators use inside.
CLASHING = "score double, row bigint, key string, kept boolean, words string, bucket int, rate double"


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    words = [f"w{rng.randrange(vocabulary)}{'.' if rng.random() < 0.1 else ''}" for _ in range(n)]
    return " ".join(words)


def odd_texts() -> list[tuple[int | None, str | None]]:
    """Null, empty, blank, repeated, non-ASCII and very long texts; null and repeated ids."""
    rng = random.Random(3)
    long = prose(rng, 30_000)
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "One two"),
        (5, "ONE two"),
        (6, "Émile É one two three ß İ"),
        (7, long),
        (8, long + " tail"),
        (9, long.upper()),
        (10, "same row"),
        (10, "same row"),
        (11, "id twice a"),
        (11, "id twice b"),
        (None, "no id"),
        (None, "same row"),
        (12, "a a a a a a a a a a a a a a a a"),
        (13, "\x0bfour\x0cblank\x1ckinds"),
    ]


def documents(spark, rows, clashing: bool = False):
    full = [(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in rows]
    if not clashing:
        return spark.createDataFrame(full, COLUMNS)
    return spark.createDataFrame(
        [(*r, 0.5, 1, "k", True, "w", 2, 0.1) for r in full], f"{COLUMNS}, {CLASHING}"
    )


def tuples(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)

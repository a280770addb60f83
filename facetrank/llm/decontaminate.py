"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item gives windows of ``WINDOW`` words (a shorter item is one
window). A document holds a window only if it holds every word of it, so by the
prefix filter one word is enough to find all candidates: the rarest, by counts
over all documents. Document words that are some window's rarest word propose
the window at one place (positional bound); it must fit into the document
(length bound), and then its words are compared with that place exactly.

Only DataFrame functions are used. The benchmark side is broadcast when its
measured size allows; else words are joined by shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetrank.llm.common import ascii_lower, stored

WINDOW = 13
SHARE = 20  # contaminated from one word in so many
BROADCAST_BYTES = 32 << 20
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words: runs of a-z, 0-9 and non-ASCII characters of the lowered text."""
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def _keyed(docs: DataFrame) -> DataFrame:
    """A document is known by its id and the hash of its text.

    Rows that repeat both have the same result.
    """
    return docs.select(
        F.col("doc_id"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"),
        words_of(F.col("text")).alias("words"),
    )


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(item_id, words)`` per window; items without words have none."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("all_words"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("all_words") - window + 1))
    return (
        items.where(F.size("all_words") > 0)
        .select("item_id", "all_words", F.explode(starts).alias("start"))
        .select("item_id", F.slice("all_words", F.col("start"), window).alias("words"))
    )


def _small(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a stored table's strings are within the limit, with a flat charge per row."""
    strings = [F.octet_length(name) for name, kind in df.dtypes if kind == "string"]
    size = sum(strings[1:], strings[0]) + F.lit(64)
    return (df.agg(F.sum(size)).first()[0] or 0) <= limit


def anchors(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``(anchor, offset, n, window)``: distinct windows with their rarest word.

    Rarity counts occurrences over all documents; ties go to the smaller word
    and then to its first place in the window.
    """
    distinct = stored(
        windows.select(F.concat_ws(" ", "words").alias("window")).distinct(), "windows"
    )
    places = distinct.select("window", F.posexplode(F.split("window", " ")).alias("offset", "word"))
    vocabulary = stored(places.select("word").distinct(), "window_words")
    occurrences = _keyed(docs).select(F.explode("words").alias("word"))
    wanted = F.broadcast(vocabulary) if _small(vocabulary) else vocabulary
    counts = occurrences.join(wanted, "word").groupBy("word").agg(F.count("*").alias("count"))
    # A word that no document has cannot be found at all; its count is 0.
    rarest = F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "word", "offset"))
    return (
        places.join(counts, "word", "left")
        .groupBy("window")
        .agg(rarest.alias("rarest"))
        .where("rarest.count > 0")
        .select(
            F.col("rarest.word").alias("anchor"),
            F.col("rarest.offset").alias("offset"),
            F.size(F.split("window", " ")).alias("n"),
            "window",
        )
    )


def hits(docs: DataFrame, anchored: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, start, n, window)``: every place that holds a window."""
    keyed = _keyed(docs)
    start = F.col("place") - F.col("offset")
    fits = (start >= 0) & (start + F.col("n") <= F.col("n_words"))
    same = F.concat_ws(" ", F.slice("words", F.col("start") + 1, F.col("n"))) == F.col("window")
    found = ["doc_id", "text_hash", "start", "n", "window"]
    if _small(anchored):
        return (
            keyed.select("*", F.size("words").alias("n_words"), F.posexplode("words").alias("place", "anchor"))
            .join(F.broadcast(anchored), "anchor")
            .where(fits)
            .withColumn("start", start)
            .where(same)
            .select(found)
        )
    candidates = (
        keyed.select(
            "doc_id",
            "text_hash",
            F.size("words").alias("n_words"),
            F.posexplode("words").alias("place", "anchor"),
        )
        .join(anchored, "anchor")
        .where(fits)
        .select("doc_id", "text_hash", start.alias("start"), "n", "window")
        .distinct()
    )
    own = keyed.dropDuplicates(["doc_id", "text_hash"]).withColumnsRenamed(
        {"doc_id": "own_id", "text_hash": "own_hash"}
    )
    together = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash"))
    return candidates.join(own, together).where(same).select(found)


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE
) -> DataFrame:
    """One row per row of ``docs``: its words, those hit by windows, and the items.

    A word is hit if it lies in any occurrence of a window; ``contaminated`` if
    at least one of ``share`` words is. Null and empty texts have no words and
    are clean. Items of fewer words than a window are one window, items without
    words none; equal items are all listed; an item without an id counts for
    hits and is not listed. Without items, or rows, the result is all clean, or
    empty. Other columns are ignored.
    """
    windows = stored(item_windows(benchmark, window), "item_windows")
    anchored = stored(anchors(docs, windows), "anchors")
    key = ["doc_id", "text_hash"]
    found = stored(hits(docs, anchored).distinct(), "window_hits")

    # Covered words without listing them: what each place adds to those before.
    end = F.col("start") + F.col("n")
    before = Window.partitionBy(*key).orderBy("start", "n")
    reached = F.max(end).over(before.rowsBetween(Window.unboundedPreceding, -1))
    covered = (
        found.select(*key, "start", "n")
        .distinct()
        .withColumn("reached", F.coalesce(reached, F.lit(0)))
        .groupBy(*key)
        .agg(F.sum(F.greatest(F.lit(0), end - F.greatest("reached", "start"))).alias("n_hit"))
    )
    named = windows.select(
        F.concat_ws(" ", "words").alias("window"), F.col("item_id").cast("string").alias("item")
    ).distinct()
    items = (
        found.select(*key, "window")
        .distinct()
        .join(F.broadcast(named) if _small(anchored) else named, "window")
        .groupBy(*key)
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    marked = covered.alias("c").join(
        items.alias("i"),
        F.col("c.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("c.text_hash") == F.col("i.text_hash")),
    )
    marked = marked.select(
        F.col("c.doc_id").alias("hit_id"), F.col("c.text_hash").alias("hit_hash"), "n_hit", "items"
    )
    sizes = _keyed(docs).select(*key, F.size("words").cast("bigint").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    items_listed = F.coalesce("items", F.array().cast("array<string>"))
    return sizes.join(
        marked,
        F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")),
        "left",
    ).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items_listed).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", items_listed).cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )

"""Quality classifier: Bradley-Terry ranking of documents.

A document's strength is a linear function of features of its whole text. Each
pair of a good and a bad training document is a preference; the weights minimise
the logistic loss of the feature differences. The threshold is the quantile of
the training strengths at the share of bad documents.

The fit uses a bounded, hash-chosen sample of labelled rows (``sample_rows``);
features and scores are made for every document on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetrank.llm.common import hash_bounds, in_arrow, stored

SAMPLE_ROWS = 40_000
OPPONENTS = 8
THRESHOLD = 0.3
FEATURES = [
    "log_bytes",
    "letters",
    "upper",
    "digits",
    "blank",
    "line_breaks",
    "sentence_marks",
    "exclamations",
    "bars",
    "other_marks",
    "word_length",
    "word_length_spread",
    "distinct_words",
    "repeats_in_row",
    "top_word",
    "marked_words",
    "upper_words",
    "distinct_lines",
    "line_words",
    "sentence_words",
]
_WORD_BATCH = 2_000


def _shares(counts: np.ndarray, chars: bytes) -> float:
    return float(counts[np.frombuffer(chars, np.uint8)].sum())


def features_of(text: bytes) -> list[float]:
    """Numbers that describe the form of a text, each between about 0 and 10."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n, n_words = len(text), len(words)
    lengths = np.fromiter(map(len, words), np.int64, n_words)
    upper = _shares(counts, bytes(range(65, 91)))
    letters = upper + _shares(counts, bytes(range(97, 123))) + float(counts[128:].sum())
    seen: dict[bytes, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    in_row = sum(a == b for a, b in zip(words, words[1:], strict=False))
    marked = sum(not w[-1:].isalnum() and w[-1] < 128 and w[-1] not in b".," for w in words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    ends = _shares(counts, b".?!")
    return [
        float(np.log10(n)),
        letters / n,
        upper / max(1.0, letters),
        _shares(counts, b"0123456789") / n,
        _shares(counts, b" \t") / n,
        float(counts[10]) / n_words,
        _shares(counts, b".,") / n_words,
        _shares(counts, b"!?") / n_words,
        _shares(counts, b"|<>{}[]\\") / n_words,
        _shares(counts, b"#$%&*@^~_=+") / n_words,
        float(lengths.mean()) / 10,
        float(lengths.std()) / 10,
        len(seen) / n_words,
        in_row / n_words,
        max(seen.values()) / n_words,
        marked / n_words,
        sum(map(bytes.isupper, words)) / n_words,
        len(set(lines)) / len(lines),
        float(np.log10(n_words / len(lines))),
        float(np.log10(n_words / max(1.0, ends))),
    ]


def _describe(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, _WORD_BATCH):
            part = batch.slice(start, _WORD_BATCH)
            rows = [features_of(text) for text in part.column(1).to_pylist()]
            columns = [pa.array(c, pa.float64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", *FEATURES])


def features(docs: DataFrame) -> DataFrame:
    """``doc_id`` and one column per feature, one row per row of ``docs``."""
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    return in_arrow(
        source, _describe, "doc_id bigint, " + ", ".join(f"{f} double" for f in FEATURES)
    )


@dataclass(frozen=True)
class BradleyTerry:
    """Strength = weights . (features - center) / scale; ``cut`` is the threshold."""

    center: list[float]
    scale: list[float]
    weights: list[float]
    cut: float

    def score(self):
        """Column in (0, 1) that is ``THRESHOLD`` exactly at the cut."""
        strength = F.lit(float(np.log(THRESHOLD / (1 - THRESHOLD)) - self.cut))
        for name, mean, spread, weight in zip(
            FEATURES, self.center, self.scale, self.weights, strict=True
        ):
            strength = strength + (F.col(name) - mean) / spread * weight
        # Kept off 0 and 1, where doubles would round.
        strength = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), strength))
        return 1.0 / (1.0 + F.exp(-strength))


def fit(x: np.ndarray, good: np.ndarray, opponents: int = OPPONENTS, ridge: float = 1e-3) -> BradleyTerry:
    """Weights from preference pairs; without both classes all weights are zero."""
    width = len(FEATURES)
    if good.all() or not good.any():
        return BradleyTerry([0.0] * width, [1.0] * width, [0.0] * width, -1.0)
    center, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    z = (x - center) / scale
    rng = np.random.default_rng(7)
    win, lose = z[good], z[~good]
    # Every document meets opponents of the other class.
    first = np.concatenate([np.repeat(np.arange(len(win)), opponents), rng.integers(len(win), size=len(lose) * opponents)])
    second = np.concatenate([rng.integers(len(lose), size=len(win) * opponents), np.repeat(np.arange(len(lose)), opponents)])
    weights = np.zeros(width)
    difference = win[first] - lose[second]
    for _ in range(25):  # Newton steps on a convex loss
        p = 1 / (1 + np.exp(np.clip(difference @ weights, -30, 30)))
        gradient = -(difference * p[:, None]).mean(0) + ridge * weights
        curve = (difference * (p * (1 - p))[:, None]).T @ difference / len(difference)
        step = np.linalg.solve(curve + ridge * np.eye(width), gradient)
        weights = weights - step
        if np.abs(step).max() < 1e-6:
            break
    strength = np.sort(z @ weights)
    bad = int((~good).sum())
    cut = float((strength[bad - 1] + strength[bad]) / 2)  # the quantile at the share of bad ones
    return BradleyTerry(center.tolist(), scale.tolist(), weights.tolist(), cut)


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Learns from at most ``sample_rows`` labelled rows outside the held-out fold,
    those with the smallest hash of doc_id. Null labels and ids are not learnt
    from; several labels of a document all count. A null or empty text has all
    features zero and is scored like any other. Without training rows of both
    classes every score is the same and above the threshold. Other columns of
    either table are ignored.
    """
    described = stored(features(docs), "quality_features")
    marks = labels.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("good")
    )
    training = stored(
        marks.where(F.col("good").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .join(described, "doc_id")
        .withColumn("number", F.xxhash64("doc_id")),
        "quality_training",
    )
    for bound in hash_bounds(training.count(), sample_rows):
        sample = (
            training.where(F.col("number") <= bound)
            .orderBy("number", "doc_id", "good")
            .limit(sample_rows)
            .select("good", *FEATURES)
            .toPandas()
        )
        if len(sample) == sample_rows:
            break
    model = fit(sample[FEATURES].to_numpy(float).reshape(-1, len(FEATURES)), sample["good"].to_numpy() == 1)
    score = model.score()
    return described.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        score.alias("score"),
        (score >= THRESHOLD).cast("int").alias("predicted"),
    )

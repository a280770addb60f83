"""The corpus pipeline: quality, near-duplicates, decontamination, mix, token files.

Each stage takes ``(spark, docs, sf_dir)`` and works on every row that its
predecessor kept. All but the last return the columns of ``documents``. Between
stages the rows are written as Parquet to the shared folder and read again, so a
stage never depends on executors of the one before.

Filtering stages decide by doc_id. A row without one cannot be looked up and
stays; rows that repeat a doc_id are kept or dropped together. Extra columns are
dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetrank.llm import decontaminate, mixing, neardup, quality
from facetrank.llm.common import stored, table
from facetrank.llm.queries import token_files

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Workers of the last stage still hold memory of those before.
WORDS_KEPT = 200_000


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    return docs.select(COLUMNS).join(dropped.select("doc_id"), "doc_id", "left_anti")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    scores = quality.quality_scores(docs, table(spark, sf_dir, "labels"))
    return _without(docs, scores.where("predicted = 0"))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component."""
    return _without(docs, neardup.near_duplicates(docs).where("not kept"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too little of the benchmark to count as contaminated."""
    marked = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, marked.where("contaminated"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the weights of their sources, in shuffled order."""
    return mixing.mix(docs).select(COLUMNS)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all copies, in the order of the mix, and what is read back.

    Rows follow their places in the files that the mix was written to, each of which
    holds a range of its shuffled order. So copies of a document are far apart.
    """
    return token_files(spark, docs, order=F.monotonically_increasing_id(), words_kept=WORDS_KEPT)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token_files", tokenized),
]

# A trained classifier and a tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

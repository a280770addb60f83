"""The operators applied to the whole test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetrank.llm import (
    convrepair,
    decontaminate,
    exactdup,
    hpylm,
    licenses,
    lines,
    mixing,
    neardup,
    packing,
    prefixtrie,
    quality,
    tokencount,
    tokenfile,
)
from facetrank.llm.common import stored, table
from facetrank.llm.sequences import crc32_of, joined_sha256
from facetrank.session import scratch_path


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpylm.scores(table(spark, sf_dir, "documents"))


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduplicated_lines(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def document_files(docs: DataFrame) -> DataFrame:
    """``documents`` as a file tree: source/lang/thousand of the id/file.

    A document that opens with a licence notice is named as a licence file.
    """
    opens = F.coalesce(F.col("text").rlike(r"(?i)^[^\n]*\b(licen[sc]ed|license)\b"), F.lit(False))
    number = F.col("doc_id").cast("string")
    return docs.select(
        F.col("doc_id").alias("file_id"),
        F.concat_ws(
            "/",
            "source",
            "lang",
            F.floor(F.col("doc_id") / 1000).cast("string"),
            F.when(opens, F.concat(F.lit("LICENSE-"), number)).otherwise(F.concat(number, F.lit(".txt"))),
        ).alias("path"),
        "text",
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = document_files(table(spark, sf_dir, "documents"))
    return licenses.scan_licenses(files).withColumnRenamed("file_id", "doc_id")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_token_counts(
    spark: SparkSession, sf_dir: str, vocabulary: str | None = None
) -> DataFrame:
    model = Path(vocabulary or public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    return tokencount.token_counts(table(spark, sf_dir, "documents"), model)


def token_files(
    spark: SparkSession, docs: DataFrame, vocabulary: str | None = None, **options
) -> DataFrame:
    """Digests of ``docs`` read back from token files written for them.

    ``options`` are those of ``tokenfile.write``.
    """
    definition = Path(vocabulary or public_tokenizers.path("word_bpe_49k.json")).read_text("utf-8")
    path = scratch_path(spark, "token_files")
    tokenfile.write(docs, path, definition, **options)
    return tokenfile.digests(spark, path)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(spark, table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_duplicates(table(spark, sf_dir, "documents"))


#: Conversations share templates in blocks of so many ids, and at most so many turns.
TEMPLATES, SHARED_TURNS = 100, 6


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns come from the first one of their block.

    Takes numbered turns; gives the ids and the turns of the rebuilt conversations.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    shared = F.pmod(crc32_of(F.col("conv_id").cast("string")), F.lit(SHARED_TURNS))
    ids = stored(
        sizes.select("conv_id", (F.col("conv_id") - F.col("conv_id") % TEMPLATES).alias("template"), shared.alias("h"))
        .join(sizes.select(F.col("conv_id").alias("template"), F.col("n").alias("offered")), "template", "left")
        .select("conv_id", "template", "h", F.least("h", F.coalesce("offered", F.lit(0))).alias("taken")),
        "rebuilt_ids",
    )
    first = turns.where(F.col("place") < SHARED_TURNS).withColumnRenamed("conv_id", "template")
    taken = ids.join(first, "template").where("place <= h").select("conv_id", "place", "name", "tokens")
    own = turns.join(ids, "conv_id").where("place > h").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "name", "tokens"
    )
    return ids.select("conv_id"), stored(taken.unionByName(own), "rebuilt_turns")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefixtrie.named_turns(table(spark, sf_dir, "conversations"))
    return prefixtrie.trie(*rebuilt_turns(turns))


def op12_pack(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    definition = Path(vocabulary or public_tokenizers.path("word_bpe_49k.json")).read_text("utf-8")
    return packing.pack_digests(table(spark, sf_dir, "documents"), definition)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversation rows with planted faults, chosen by conversation and turn."""
    key = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    )
    kind = F.pmod(crc32_of(key), F.lit(20))
    text = F.coalesce("text", F.lit(" "))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"),
        kind.alias("kind"),
    )
    return rows.where("kind != 0").drop("kind")


def repair_digests(conversations: DataFrame, chunk: int = convrepair.CHUNK) -> DataFrame:
    """What the repair of the damaged rows did, for each conversation there is."""
    rows = damaged(conversations)
    repaired, report = convrepair.repair(rows, chunk)
    sums = joined_sha256(
        repaired.select(
            "conv_id", "task", "nth", "place", F.concat_ws(":", "role", "text").alias("line")
        ),
        ["conv_id"],
        [F.col("task"), F.col("nth"), F.col("place")],
        F.col("line"),
        b"\n",
    )
    every = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    told = report.withColumnRenamed("conv_id", "_told")
    hashed = sums.withColumnRenamed("conv_id", "_hashed")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (
        every.join(told, F.col("conv_id").eqNullSafe(F.col("_told")), "left")
        .join(hashed, F.col("conv_id").eqNullSafe(F.col("_hashed")), "left")
        .select(
            "conv_id",
            *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
        )
    )


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_digests(table(spark, sf_dir, "conversations"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_lm_scores": op1_lm_scores,
        "op2_mix": op2_mix,
        "op3_line_dedup": op3_line_dedup,
        "op4_decontaminate": op4_decontaminate,
        "op5_licenses": op5_licenses,
        "op6_near_dedup": op6_near_dedup,
        "op7_token_counts": op7_token_counts,
        "op8_token_files": op8_token_files,
        "op9_quality": op9_quality,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_pack": op12_pack,
        "op13_structure_repair": op13_structure_repair,
    }

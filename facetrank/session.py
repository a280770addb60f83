"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SCRATCH_DATABASE = "facetrank_scratch"


def build_session(
    app: str = "facetrank", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """Session with adaptive execution on.

    Sizes (shuffle partitions, memory) belong to the cluster: pass them in
    ``conf`` or set them at submit time. ANSI mode stays at Spark's default.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # The star joins chain on one key without a shuffle between them; let
        # a skewed key be split even when that costs one more shuffle.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Tables beyond 25 TB need more buckets than Spark allows by default.
        .config("spark.sql.sources.bucketing.maxBuckets", "1000000")
    )
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Where no checkpoint folder is set, the session's warehouse serves: tables
    have to be shared as well.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/facetrank_scratch_files"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing exists there yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def scratch_database(spark: SparkSession) -> str:
    """A database of scratch tables, stored below the shared folder."""
    folder = shared_folder(spark)
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS {SCRATCH_DATABASE} LOCATION '{folder}/{SCRATCH_DATABASE}'"
    )
    return SCRATCH_DATABASE


def scratch_name(name: str) -> str:
    """A fresh table name."""
    return f"{name}_{uuid.uuid4().hex[:12]}"

"""Stored tables: each replace is a new folder and one change of the table's location.

A table is external and points at one version folder below its root. A replace
writes a folder of its own and then moves the pointer, so there is no moment
without a table, its properties and grants stay, nothing is renamed, and frames
that were opened before go on reading the version they have seen. Old versions
stay until :func:`clean_versions` or :func:`drop_table`.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from facetrank.operators import new_rows, one_row_per_key
from facetrank.session import scratch_path

BUCKET_BYTES = 256 << 20
_BUCKET_LIMIT = "spark.sql.sources.bucketing.maxBuckets"


def qualified(table: str, database: str | None = None) -> str:
    return f"`{database}`.`{table}`" if database else f"`{table}`"


def _use(spark: SparkSession, table: str, database: str | None) -> str:
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    return qualified(table, database)


def _facts(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalog says about a table: provider, location, buckets and so on."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def _versions_root(spark: SparkSession, table: str, database: str | None, path: str | None) -> str:
    """Folder of the versions of a table: the caller's, or one beside the database's tables."""
    if path:
        return path.rstrip("/")
    owner = database or spark.catalog.currentDatabase()
    return f"{spark.catalog.getDatabase(owner).locationUri.rstrip('/')}/{table}.versions"


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, as Hadoop's interface gives them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def stored_bytes(spark: SparkSession, path: str) -> int:
    folder, files = hadoop_path(spark, path)
    return files.getContentSummary(folder).getLength()


def bucket_count(spark: SparkSession, size: int) -> int:
    """Buckets of about ``BUCKET_BYTES`` for ``size`` stored bytes."""
    wanted = max(1, -(-size // BUCKET_BYTES))
    limit = int(spark.conf.get(_BUCKET_LIMIT))
    if wanted > limit:
        raise ValueError(f"{wanted} buckets are needed; {_BUCKET_LIMIT} allows {limit}")
    return wanted


def _bucketed(
    spark: SparkSession, df: DataFrame, by: str, buckets: int | None, known: str | None
) -> tuple[DataFrame, int]:
    """Rows to write and their number of buckets.

    A table keeps its number. Otherwise, without ``buckets``, the rows are stored
    once as they come and the bytes counted.
    """
    if known:
        if buckets and buckets != int(known):
            raise ValueError(f"the table has {known} buckets, not {buckets}; drop it to change that")
        return df, int(known)
    if buckets:
        return df, buckets
    path = scratch_path(spark, "unbucketed")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), bucket_count(spark, stored_bytes(spark, path))


def _check_replaceable(
    name: str, old: DataFrame, df: DataFrame, facts: dict[str, str], bucket_by: str | None
) -> None:
    before = {f.name: f.dataType for f in old.schema}
    if before != (after := {f.name: f.dataType for f in df.schema}):
        raise ValueError(f"{name} has the columns {before}, not {after}")
    if facts.get("Provider", "").lower() != "parquet" or "# Partition Information" in facts:
        raise ValueError(f"{name} is not a plain parquet table")
    wanted = f"[`{bucket_by}`]" if bucket_by else None
    if facts.get("Bucket Columns", wanted) != wanted or (wanted and "Num Buckets" not in facts):
        raise ValueError(f"{name} is bucketed by {facts.get('Bucket Columns')}, not by {wanted}")


def overwrite_table(
    df: DataFrame,
    table: str,
    database: str | None = None,
    path: str | None = None,
    bucket_by: str | None = None,
    buckets: int | None = None,
    clustered: bool = False,
) -> DataFrame:
    """Replace a parquet table with the rows of ``df`` and return it.

    Rows go to a folder of their own, below ``path`` or beside the database's
    tables; the table's location is moved to it when they are complete. A failed
    run leaves the old rows; frames opened before read on. An existing table must
    have the columns and the bucketing of ``df``, and keeps its properties.

    With ``bucket_by`` rows are clustered first, so that a bucket is one sorted
    file; one too large for a task is split at run time into several files of
    the same bucket. ``clustered`` skips that for rows that come from files of
    the same buckets. Without ``buckets`` a new table gets as many as its stored
    bytes need; an existing one keeps its number.
    """
    spark = df.sparkSession
    name = _use(spark, table, database)
    facts = _facts(spark, name) if spark.catalog.tableExists(name) else None
    if facts is not None:
        _check_replaceable(name, spark.table(name), df, facts, bucket_by)
    if bucket_by:
        known = facts.get("Num Buckets") if facts else None
        df, buckets = _bucketed(spark, df, bucket_by, buckets, known)
        if not clustered:
            df = df.hint("rebalance", buckets, F.col(bucket_by))
    run = uuid.uuid4().hex[:12]
    target = f"{_versions_root(spark, table, database, path)}/{run}"
    writer = df.write.format("parquet").option("path", target)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    if facts is None:
        writer.saveAsTable(name)
        return spark.table(name)
    # Buckets can only be written through a table; dropping it leaves the files.
    fresh = qualified(f"{table}_{run}", database)
    writer.saveAsTable(fresh)
    spark.sql(f"DROP TABLE {fresh}")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{target}'")
    return spark.table(name)


def clean_versions(
    spark: SparkSession,
    table: str,
    database: str | None = None,
    path: str | None = None,
    older_than: float = 7 * 24 * 3600,
) -> int:
    """Delete versions that the table no longer points at; returns how many.

    ``older_than`` (seconds since a version was written) has to outlast the
    longest job that may still read one.
    """
    folder, files = hadoop_path(spark, _versions_root(spark, table, database, path))
    if not files.exists(folder):
        return 0
    current = spark._jvm.org.apache.hadoop.fs.Path(_facts(spark, qualified(table, database))["Location"])
    before = (time.time() - older_than) * 1000
    gone = 0
    for status in files.listStatus(folder):
        old = status.getPath().getName() != current.getName() and status.getModificationTime() <= before
        gone += bool(old and files.delete(status.getPath(), True))
    return gone


def drop_table(
    spark: SparkSession, table: str, database: str | None = None, path: str | None = None
) -> None:
    """Drop a table and delete all its versions."""
    folder, files = hadoop_path(spark, _versions_root(spark, table, database, path))
    spark.sql(f"DROP TABLE IF EXISTS {qualified(table, database)}")
    files.delete(folder, True)


def _by_position(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns renamed and cast to the target, matched by position."""
    if len(df.columns) != len(schema):
        raise ValueError(f"{len(df.columns)} columns for {len(schema)}: {df.columns}")
    return df.toDF(*schema.names).select(
        *[F.col(field.name).cast(field.dataType).alias(field.name) for field in schema]
    )


def insert_overwrite(
    df: DataFrame,
    table: str,
    schema: StructType,
    database: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Create the result table if needed and replace its rows, by position.

    An existing table of another schema is an error.
    """
    return overwrite_table(_by_position(df, schema), table, database, path)


def append_rows(
    df: DataFrame, table: str, database: str | None = None, path: str | None = None
) -> DataFrame:
    """Add rows to a table; running it twice adds them twice."""
    spark = df.sparkSession
    name = _use(spark, table, database)
    writer = df.write.format("parquet").mode("append")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return spark.table(name)


def merge_rows(
    df: DataFrame,
    table: str,
    key: Sequence[str],
    prefer: Sequence[Column],
    database: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Add the rows whose key the table does not have yet; one row per key.

    Of several new rows of a key the first by ``prefer`` is added; a key that is there
    keeps its row. So the table has one row per key, readers need no rank, and rows
    that are given twice add nothing.
    """
    spark = df.sparkSession
    name = _use(spark, table, database)
    fresh = one_row_per_key(df, key, prefer)
    if spark.catalog.tableExists(name):
        fresh = new_rows(fresh, spark.table(name), key)
    return append_rows(fresh, table, database, path)


def replace_view(df: DataFrame, name: str) -> DataFrame:
    """Create a session view or replace the one of that name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)

"""Helpers that several operators share."""

from __future__ import annotations

import shutil
import tempfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from facetrank.session import scratch_path

PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ascii_lower(text: Column) -> Column:
    """Text with A-Z lowered and every other character as it was; null is empty.

    ``lower`` also changes other alphabets, so it serves pure ASCII texts only.
    """
    text = F.coalesce(text, F.lit(""))
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


@contextmanager
def freed_shuffles(spark: SparkSession):
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Cuts the lineage: what follows does not depend on shuffle files of executors
    that may be lost, and those files are freed when the write has ended.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def hash_bounds(rows: int, wanted: int):
    """Rising bounds of a 64-bit hash to look below for the ``wanted`` smallest of ``rows`` rows.

    About ``wanted`` rows lie below the first, so tasks send few others; where rows
    that repeat a value leave too few, the next bound is tried. The last holds all.
    """
    share = (wanted + 6 * wanted**0.5 + 10) / max(rows, 1)
    while share < 1:
        yield int(share * 2**64) - 2**63
        share *= 4
    yield 2**63 - 1


def discard(df: DataFrame) -> None:
    """Delete what ``stored`` wrote for ``df``, once nothing reads it any more."""
    context = df.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application.

    The archive is served by the driver; it is not read from a local path.
    """
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        target = f"{tempfile.mkdtemp(prefix='package-')}/{PACKAGE.name}"
        archive = shutil.make_archive(target, "zip", PACKAGE.parent, PACKAGE.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)


def in_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with this package on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)

"""The five inputs: from text files, into tables, and back."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from facetrank.schemas import INPUTS, TitleTables
from facetrank.sinks.tables import overwrite_table, qualified
from facetrank.sources.delimited import read_delimited


def read_titles(
    spark: SparkSession,
    paths: Mapping[str, str],
    header: Mapping[str, bool] | None = None,
    quoted: bool = False,
    trim_items: bool = False,
) -> TitleTables:
    """The inputs straight from text; ``paths`` maps input name to path.

    ``header`` overrides the header flag of single inputs.
    """
    flags = {name: form.header for name, form in INPUTS.items()} | dict(header or {})
    return TitleTables(
        **{
            name: read_delimited(
                spark,
                paths[name],
                form.schema,
                flags[name],
                quoted=quoted,
                trim_items=trim_items,
            )
            for name, form in INPUTS.items()
        }
    )


def load_titles(
    tables: TitleTables,
    database: str | None = None,
    folder: str | None = None,
    buckets: int | None = None,
    prefix: str = "",
) -> TitleTables:
    """Replace the five stored tables and return them.

    Tables are bucketed by their join key, which makes the star joins of all
    later queries free of shuffles.
    """
    stored = {}
    for name, form in INPUTS.items():
        df = getattr(tables, name)
        stored[name] = overwrite_table(
            df,
            prefix + name,
            database=database,
            path=f"{folder}/{name}" if folder else None,
            bucket_by=form.key,
            buckets=buckets,
        )
    return TitleTables(**stored)


def open_titles(spark: SparkSession, database: str | None = None, prefix: str = "") -> TitleTables:
    """The stored tables."""

    def table(name: str) -> DataFrame:
        return spark.table(qualified(prefix + name, database))

    return TitleTables(**{name: table(name) for name in INPUTS})

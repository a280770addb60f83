"""Delimited text output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from facetrank.schemas import FIELD_SEP, ITEM_SEP, MISSING


def as_text(df: DataFrame, item_sep: str = ITEM_SEP, missing: str = MISSING) -> DataFrame:
    """Every column as text: arrays joined, NULL as the marker."""

    def cell(field) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, ArrayType):
            column = F.array_join(column.cast("array<string>"), item_sep)
        return F.coalesce(column.cast("string"), F.lit(missing)).alias(field.name)

    return df.select(*[cell(field) for field in df.schema])


def is_writable(df: DataFrame, sep: str = FIELD_SEP, item_sep: str = ITEM_SEP) -> Column:
    """Whether all text of a row keeps its place in delimited lines."""

    def holds(text: Column, *marks: str) -> Column:
        found = F.lit(False)
        for mark in marks:
            found = found | F.contains(text, F.lit(mark))
        return F.coalesce(found, F.lit(False))

    torn = F.lit(False)
    for field in df.schema:
        if isinstance(field.dataType, StringType):
            torn = torn | holds(F.col(field.name), sep, "\n", "\r")
        elif isinstance(field.dataType, ArrayType):
            items = F.col(field.name).cast("array<string>")
            torn = torn | F.coalesce(
                F.exists(items, lambda x: holds(x, sep, item_sep, "\n", "\r")), F.lit(False)
            )
    return ~torn


def write_delimited(
    df: DataFrame,
    path: str,
    header: bool = False,
    sep: str = FIELD_SEP,
    item_sep: str = ITEM_SEP,
    missing: str = MISSING,
    mode: str = "errorifexists",
) -> None:
    """One line per row, no quoting. With ``header`` each file starts with the names.

    Values are written as they are. One that holds the separator or a line break,
    or an array item that holds the item separator, would tear its row and is
    an error; :func:`is_writable` tells such rows in advance.
    """
    refused = F.raise_error(F.lit("a value holds a separator or a line break"))
    whole = df.where(F.when(is_writable(df, sep, item_sep), True).otherwise(refused.cast("boolean")))
    text = as_text(whole, item_sep, missing)
    if not header:
        lines = text.select(F.concat_ws(sep, *text.columns).alias("line"))
        lines.write.mode(mode).text(path)
        return
    (
        text.write.mode(mode)
        .option("sep", sep)
        .option("header", True)
        .option("quote", "")
        .option("escapeQuotes", False)
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )

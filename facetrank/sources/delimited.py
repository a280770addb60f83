"""Delimited text with declared types."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from facetrank.functions.cells import split_items
from facetrank.schemas import FIELD_SEP, ITEM_SEP, MISSING

_BAD_LINE = "_bad_line"
_BLANK = r"^[\x00-\x20]*$"
# Never found in text; keeps the reader from treating anything as NULL by itself.
_NO_MARKER = "\u0000"


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    header: bool,
    sep: str = FIELD_SEP,
    item_sep: str = ITEM_SEP,
    missing: str = MISSING,
    quoted: bool = False,
    trim_items: bool = False,
) -> DataFrame:
    """Read files whose columns are, in order, those of ``schema``.

    Works on any path Spark can open, local, distributed or object store.

    - The header line of each file is skipped; its names are not used. It must
      not be blank.
    - Every line is a row, blank ones too.
    - The missing-value marker is NULL in every column.
    - A number that does not parse is NULL; so is a field absent from a short
      line. Extra fields are ignored.
    - An empty field is '' in a text column and an empty array in an array one.
    - Quotes and backslashes are ordinary characters unless ``quoted``; then a
      field may hold separators, but not line breaks.
    """

    def typed(text: Column, field: StructField) -> Column:
        text = F.nullif(text, F.lit(missing))
        if isinstance(field.dataType, ArrayType):
            return split_items(text, item_sep, trim_items)
        if isinstance(field.dataType, StringType):
            return text
        return text.try_cast(field.dataType)

    lines = spark.read.option("lineSep", "\n").text(path)
    fields = F.split("value", re.escape(sep))
    by_line = [typed(F.get(fields, F.lit(i)), f).alias(f.name) for i, f in enumerate(schema)]
    if not (header or quoted):
        return lines.select(*by_line)
    raw_schema = StructType(
        [StructField(f.name, StringType(), True) for f in schema]
        + [StructField(_BAD_LINE, StringType(), True)]
    )
    options = {
        "sep": sep,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _BAD_LINE,
        "nullValue": _NO_MARKER,
        "quote": '"' if quoted else "",
        "escape": '"' if quoted else "",
    }

    # The parser gives NULL for an empty field; only a short line lacks fields.
    def filled(row: Column) -> list[Column]:
        bad = row[_BAD_LINE]
        outside = F.regexp_replace(bad, '"([^"]|"")*"', "") if quoted else bad
        n_fields = F.size(F.split(outside, re.escape(sep)))
        found = []
        for i, field in enumerate(schema):
            absent = bad.isNotNull() & (n_fields <= i)
            present = F.when(~absent, F.coalesce(row[field.name], F.lit("")))
            found.append(typed(present, field).alias(field.name))
        return found

    if not header:
        # Each line by itself, from one scan. All fields of a line are looked at, as
        # short lines are not found otherwise; within a lambda none is pruned.
        parsed = F.from_csv("value", F.lit(raw_schema.toDDL()), options)
        row = F.get(F.transform(F.array(parsed), lambda row: F.struct(*filled(row))), F.lit(0))
        blank = F.struct(*by_line)
        line = F.when(F.col("value").rlike(_BLANK), blank).otherwise(row)
        return lines.select(line.alias("_line")).select("_line.*")
    # The CSV reader knows headers, but drops blank lines.
    reader = spark.read.schema(raw_schema).options(**options)
    reader = reader.option("header", True).option("lineSep", "\n").option("columnPruning", False)
    raw = reader.csv(path)
    whole = raw.select(F.struct(*raw.columns).alias("row")).select(*filled(F.col("row")))
    return whole.unionByName(lines.where(F.col("value").rlike(_BLANK)).select(*by_line))

"""Expressions over single text cells."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from facetrank.schemas import FIELD_SEP, ITEM_SEP, MISSING


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing_to_null(c: Column | str, marker: str = MISSING) -> Column:
    """NULL where the cell holds the missing-value marker."""
    return F.nullif(_col(c), F.lit(marker))


def missing_words_to_null(c: Column | str, words: tuple[str, ...] = ("", "N/A")) -> Column:
    """NULL where the cell holds one of several words for "nothing"."""
    out = _col(c)
    for word in words:
        out = F.nullif(out, F.lit(word))
    return out


def split_items(c: Column | str, sep: str = ITEM_SEP, trim: bool = False) -> Column:
    """Collection cell to array: '' is an empty array, NULL stays NULL.

    Items keep their blanks unless ``trim`` is set; empty items are kept.
    """
    text = _col(c)
    pattern = re.escape(sep)
    if trim:
        text, pattern = F.trim(text), rf"\s*{pattern}\s*"
    empty = F.array().cast("array<string>")
    return F.when(text == "", empty).otherwise(F.split(text, pattern))


def tokenize(c: Column | str, sep: str = ITEM_SEP) -> Column:
    """Array of the non-empty tokens of a cell."""
    return F.array_remove(F.split(_col(c), re.escape(sep)), "")


def strip_quotes(c: Column | str) -> Column:
    """Remove every double quote."""
    return F.translate(_col(c), '"', "")


def split_field(c: Column | str, position: int, sep: str = FIELD_SEP) -> Column:
    """The ``position``-th (from 1) separated field; NULL if the line is shorter."""
    return F.get(F.split(_col(c), re.escape(sep)), F.lit(position - 1))


def json_field(c: Column | str, name: str) -> Column:
    """Top-level JSON field as text; NULL if it is absent, null or the body is bad."""
    return F.get_json_object(_col(c), f"$['{name}']")

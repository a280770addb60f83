"""Column expressions; all are built-in functions that stay in the JVM."""

from facetrank.functions.cells import (
    json_field,
    missing_to_null,
    missing_words_to_null,
    split_field,
    split_items,
    strip_quotes,
    tokenize,
)
from facetrank.functions.means import (
    mean_from_sums,
    sums_of,
    weigh,
    weighted_mean,
)

__all__ = [
    "json_field",
    "mean_from_sums",
    "missing_to_null",
    "missing_words_to_null",
    "split_field",
    "split_items",
    "strip_quotes",
    "sums_of",
    "tokenize",
    "weigh",
    "weighted_mean",
]

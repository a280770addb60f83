"""DataFrame-to-DataFrame operators, generic in the column names."""

from facetrank.operators.explode import deal, explode_facets, tokenize_facets
from facetrank.operators.filters import drop_missing, keep_filled, without_values
from facetrank.operators.gather import collect_sorted, distinct_values, group_max
from facetrank.operators.joins import look_up, new_rows, star_join
from facetrank.operators.ranking import (
    argmax_ties,
    one_row_per_key,
    rank_large_groups,
    rank_within,
    rerank_dense,
    top_k,
    top_ties,
)

__all__ = [
    "argmax_ties",
    "collect_sorted",
    "deal",
    "distinct_values",
    "drop_missing",
    "explode_facets",
    "group_max",
    "keep_filled",
    "look_up",
    "new_rows",
    "one_row_per_key",
    "rank_large_groups",
    "rank_within",
    "rerank_dense",
    "star_join",
    "tokenize_facets",
    "top_k",
    "top_ties",
    "without_values",
]

"""The ranking reports, built from the operators."""

from facetrank.plans.batch import (
    FacetBatch,
    facet_batch,
    facet_report,
    run_facet_batch,
    store_rankings,
    top_genres_with_directors,
)
from facetrank.plans.reports import (
    best_director,
    best_director_for_genres,
    top_genre,
)
from facetrank.plans.rules import EXACT, STAGED, FacetRules

__all__ = [
    "EXACT",
    "STAGED",
    "FacetBatch",
    "FacetRules",
    "best_director",
    "best_director_for_genres",
    "facet_batch",
    "facet_report",
    "run_facet_batch",
    "store_rankings",
    "top_genre",
    "top_genres_with_directors",
]

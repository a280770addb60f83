"""What the ranking reports count, and how two published variants differ."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class FacetRules:
    """Rules of a report; use ``dataclasses.replace`` to change single ones."""

    # Fixed values of the reports.
    title_type: str = "movie"
    min_year: int = 2010
    excluded_genre: str | None = "movie"
    keep: int = 3

    # Directors are compared on a mean rounded to this many digits; None: exact.
    director_digits: int | None = 1
    # Decimals that all ratings keep to, with whole votes: spares an aggregation, and
    # other numbers are errors. None: any doubles.
    scale: int | None = None
    # Only titles with a director entry count in the genre means.
    genres_need_directors: bool = False
    # Look names up before the ranking, so that a director without a name makes
    # room for the next one. Otherwise an unnamed winner leaves the group empty.
    named_directors_only: bool = False
    # Empty items of the genre, country and director lists are dropped.
    drop_empty_items: bool = False
    # Countries may have been appended twice: keep one row per title.
    dedupe_countries: bool = False


STAGED = FacetRules()
EXACT = FacetRules(
    excluded_genre=None,
    director_digits=None,
    genres_need_directors=True,
    named_directors_only=True,
    drop_empty_items=True,
)

"""The single reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from facetrank.operators import (
    collect_sorted,
    drop_missing,
    look_up,
    rank_within,
    top_k,
    top_ties,
)
from facetrank.plans.facts import director_means, genre_means
from facetrank.plans.rules import STAGED, FacetRules
from facetrank.schemas import TitleTables

GROUP = ["country", "genre"]


def top_genre(tables: TitleTables, rules: FacetRules = STAGED) -> DataFrame:
    """Every genre of every country with its weighted mean rating and rank."""
    return rank_genres(genre_means(tables, rules))


def rank_genres(means: DataFrame) -> DataFrame:
    """Rank (country, genre, weightedAveRating) rows within their country."""
    return rank_within(means, ["country"], "weightedAveRating")


def best_director(tables: TitleTables, rules: FacetRules = STAGED) -> DataFrame:
    """All best-rated directors of every (country, genre)."""
    return winners(director_means(tables, rules), tables.names, rules)


def winners(means: DataFrame, names: DataFrame, rules: FacetRules) -> DataFrame:
    """The named winners among (country, genre, director, weighted_rating) rows.

    Ranks are taken on ids; names come last, for the winners only, and so that the
    means are worked out once for the maxima and for the rows that reach them. Where the
    rules want unnamed directors out of the contest, ids without a name are left
    out before it.
    """
    on, take = ("director", "nameId"), {"primaryName": "director_name"}
    if rules.named_directors_only:
        names = drop_missing(names, ["primaryName"])
        ids = names.select(F.col("nameId").alias("director"))
        means = means.join(ids, "director", "left_semi")
    won = look_up(top_ties(means, GROUP, "weighted_rating"), names, on, take, read_twice=True)
    return won.select(*GROUP, "director_name", "weighted_rating")


def best_director_for_genres(genres: DataFrame, directors: DataFrame, keep: int = 3) -> DataFrame:
    """The first genres of each country with an array of their best directors.

    Takes the results (or stored tables) of :func:`top_genre` and
    :func:`best_director`. Genres without a director do not count.
    """
    rows = directors.select(*GROUP, "director_name")
    before = genres.select(*GROUP, F.col("ranking").alias("_before"))
    return first_genres(before, rows, F.col("_before"), keep, [])


def first_genres(
    genres: DataFrame, rows: DataFrame, order: Column, keep: int, carry: list[str]
) -> DataFrame:
    """From the winners of each genre (``rows``) to one row per kept genre.

    ``genres`` holds a row per (country, genre) with what ``order`` reads. Genres
    with a winner are cut before names are joined and collected, so the windows
    see genres, never winners; the second one sees ``keep`` of them per country.
    Ties in the cut go by genre. Ranks are dense.
    """
    won = rows.select(*GROUP).distinct()
    kept = top_k(genres.join(won, GROUP), ["country"], [order, F.col("genre")], keep)
    place = F.dense_rank().over(W.partitionBy("country").orderBy(order))
    ranked = kept.select(*GROUP, place.alias("ranking"), *carry)
    return collect_sorted(
        rows.join(ranked, GROUP), [*GROUP, "ranking", *carry], "director_name", "best_directors"
    )

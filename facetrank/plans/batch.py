"""The whole batch: both rankings and their merge."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetrank.plans.facts import facet_means
from facetrank.plans.reports import (
    GROUP,
    best_director_for_genres,
    first_genres,
    rank_genres,
    winners,
)
from facetrank.plans.rules import EXACT, STAGED, FacetRules
from facetrank.schemas import (
    BEST_DIRECTOR,
    BEST_DIRECTOR_FOR_GENRES,
    TOP_GENRE,
    TitleTables,
)
from facetrank.session import scratch_path
from facetrank.sinks.tables import insert_overwrite
from facetrank.sources.titles import load_titles, read_titles

class FacetBatch(NamedTuple):
    top_genre: DataFrame
    best_director: DataFrame
    best_director_for_genres: DataFrame


def facet_report(tables: TitleTables, rules: FacetRules = STAGED) -> DataFrame:
    """Best directors of the first genres of each country, in one lazy plan.

    (country, genre, ranking, weightedAveRating, best_directors). Genre and
    director means come out of one aggregation over one star join; its shuffle is
    reused by the parts of the plan that read it.
    """
    means = facet_means(tables, rules)
    genres = means.where("is_genre").select(*GROUP, F.col("mean").alias("weightedAveRating"))
    directors = means.where(~F.col("is_genre")).select(
        *GROUP, "director", F.col("mean").alias("weighted_rating")
    )
    won = winners(directors, tables.names, rules)
    return first_genres(
        genres, won, F.desc("weightedAveRating"), rules.keep, ["weightedAveRating"]
    ).select(*GROUP, "ranking", "weightedAveRating", "best_directors")


def top_genres_with_directors(tables: TitleTables, rules: FacetRules = EXACT) -> DataFrame:
    """The report with means instead of ranks: (country, genre, weightedAveRating, topDirectors)."""
    return facet_report(tables, rules).select(
        *GROUP, "weightedAveRating", F.col("best_directors").alias("topDirectors")
    )


def facet_batch(
    tables: TitleTables, means: DataFrame | None = None, rules: FacetRules = STAGED
) -> FacetBatch:
    """The three results. Pass stored ``means`` to compute the sums only once."""
    means = facet_means(tables, rules) if means is None else means
    genres = rank_genres(
        means.where("is_genre").select(*GROUP, F.col("mean").alias("weightedAveRating"))
    )
    directors = means.where(~F.col("is_genre")).select(
        *GROUP, "director", F.col("mean").alias("weighted_rating")
    )
    best = winners(directors, tables.names, rules)
    return FacetBatch(genres, best, best_director_for_genres(genres, best, rules.keep))


def store_rankings(
    tables: TitleTables,
    database: str | None = None,
    folder: str | None = None,
    rules: FacetRules = STAGED,
) -> FacetBatch:
    """Compute the three results and replace their tables.

    The means are written to the shared folder, so the sums are computed once, a
    lost executor costs one stage at most, and each step reads what the one
    before has stored.
    """

    def at(name: str) -> str | None:
        return f"{folder}/{name}" if folder else None

    # Genre and director rows lie apart: each reader scans only its own.
    lazy_means = facet_means(tables, rules)
    path = scratch_path(lazy_means.sparkSession, "facet_means")
    lazy_means.write.partitionBy("is_genre").parquet(path)
    means = lazy_means.sparkSession.read.schema(lazy_means.schema).parquet(path)
    lazy = facet_batch(tables, means, rules)
    genres = insert_overwrite(lazy.top_genre, "top_genre", TOP_GENRE, database, at("top_genre"))
    directors = insert_overwrite(
        lazy.best_director, "best_director", BEST_DIRECTOR, database, at("best_director")
    )
    merged = insert_overwrite(
        best_director_for_genres(genres, directors, rules.keep),
        "best_director_for_genres",
        BEST_DIRECTOR_FOR_GENRES,
        database,
        at("best_director_for_genres"),
    )
    return FacetBatch(genres, directors, merged)


def run_facet_batch(
    spark: SparkSession,
    paths: Mapping[str, str],
    database: str | None = None,
    folder: str | None = None,
    buckets: int | None = None,
    rules: FacetRules = STAGED,
    header: Mapping[str, bool] | None = None,
) -> FacetBatch:
    """Text files in, stored tables out."""
    tables = load_titles(read_titles(spark, paths, header), database, folder, buckets)
    return store_rankings(tables, database, folder, rules)

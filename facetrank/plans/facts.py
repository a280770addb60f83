"""Shared first half of the reports: star join, explode, weighted sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from facetrank.functions.means import mean_from_sums, sums_of, weigh
from facetrank.operators import (
    deal,
    drop_missing,
    explode_facets,
    keep_filled,
    one_row_per_key,
    star_join,
)
from facetrank.plans.rules import FacetRules
from facetrank.schemas import TitleTables

FACETS = {"genres": "genre", "countries": "country"}


def join_titles(titles: DataFrame, *others: DataFrame, how: str = "inner") -> DataFrame:
    """Star join of title tables.

    They all grow with the number of titles, so none is broadcast: buckets (or
    shuffled partitions) of the same titles are merged, and a skewed one can be
    split at run time.
    """
    return star_join(titles, *others, key="titleId", how=how, strategy="merge")


def eligible_titles(basics: DataFrame, rules: FacetRules) -> DataFrame:
    """Titles of the right type and age that have genres; filters reach the scan."""
    chosen = basics.where(
        (F.col("titleType") == rules.title_type) & (F.col("startYear") >= rules.min_year)
    )
    return drop_missing(chosen.select("titleId", "genres"), ["titleId", "genres"])


def rated_titles(tables: TitleTables, rules: FacetRules) -> DataFrame:
    """Eligible titles with their countries and weighted rating parts."""
    ratings = drop_missing(
        tables.ratings.select("titleId", "rating", "numVotes"), ["rating", "numVotes"]
    )
    countries = drop_missing(
        tables.countries.select("titleId", F.col("country").alias("countries")), ["countries"]
    )
    if rules.dedupe_countries:
        countries = one_row_per_key(countries, ["titleId"], [F.col("countries")])
    titles = join_titles(eligible_titles(tables.basics, rules), ratings, countries)
    return weigh(titles, "rating", "numVotes", rules.scale)


def credited_titles(tables: TitleTables, rules: FacetRules) -> DataFrame:
    """Rated titles with at least one director."""
    crew = keep_filled(tables.crew.select("titleId", "directors"), "directors")
    return join_titles(rated_titles(tables, rules), crew)


def explode_by_rules(titles: DataFrame, facets: dict[str, str], rules: FacetRules) -> DataFrame:
    if rules.drop_empty_items:
        for array in facets:
            titles = titles.withColumn(array, F.array_remove(array, ""))
    exclude = {"genre": [rules.excluded_genre]} if rules.excluded_genre is not None else None
    return explode_facets(titles.drop("titleId"), facets, exclude)


def genre_means(tables: TitleTables, rules: FacetRules) -> DataFrame:
    """(country, genre, weightedAveRating)."""
    titles = rated_titles(tables, rules)
    if rules.genres_need_directors:
        crew = drop_missing(tables.crew.select("titleId", "directors"), ["directors"])
        titles = join_titles(titles, crew.select("titleId"))
    sums = sums_of(explode_by_rules(titles, FACETS, rules), ["country", "genre"], rules.scale)
    return sums.select("country", "genre", mean_from_sums().alias("weightedAveRating"))


def director_means(tables: TitleTables, rules: FacetRules) -> DataFrame:
    """(country, genre, director, weighted_rating)."""
    by = ["country", "genre", "director"]
    credits = explode_by_rules(credited_titles(tables, rules), {"directors": "director"}, rules)
    rows = explode_by_rules(deal(credits, F.col("director")), FACETS, rules)
    return sums_of(rows, by, rules.scale).select(
        *by, mean_from_sums(rules.director_digits).alias("weighted_rating")
    )


def facet_means(tables: TitleTables, rules: FacetRules) -> DataFrame:
    """Genre means and director means of one pass over the inputs.

    (country, genre, is_genre, director, mean): each title counts once in the
    row of its genre (``is_genre``, director NULL) and once for each director.
    The genre's own place is put in front of the director list before the
    explode, so both come out of one star join and one aggregation. Places are
    dealt by director before genres and countries multiply them.
    """
    crew = tables.crew.select("titleId", "directors")
    titles = rated_titles(tables, rules)
    if rules.genres_need_directors:
        crew = drop_missing(crew, ["directors"]).withColumn("_own", F.lit(True))
        titles = join_titles(titles, crew)
    else:
        # Here the crew must not multiply the genre's share: one crew row of a
        # title carries it. Any row will do. The numbering streams over rows that
        # the merge join clusters and sorts in the same way.
        nth = F.row_number().over(W.partitionBy("titleId").orderBy("titleId"))
        crew = crew.withColumn("_own", nth == 1)
        titles = join_titles(titles, crew, how="left")
        titles = titles.withColumn("_own", F.coalesce("_own", F.lit(True)))
    no_items = F.array().cast("array<string>")
    directors = F.coalesce("directors", no_items)
    if rules.drop_empty_items:
        directors = F.array_remove(directors, "")
    own_place = F.when(F.col("_own"), F.array(F.lit(None).cast("string"))).otherwise(no_items)
    kept = [c for c in titles.columns if c != "directors"]
    places = F.posexplode(F.concat(own_place, directors)).alias("_place", "director")
    places = titles.select(*kept, places)
    # A genre's own places have no director: they are dealt by title.
    rows = explode_by_rules(deal(places, F.coalesce("director", "titleId")), FACETS, rules)
    sums = sums_of(
        rows.withColumn("is_genre", F.col("_own") & (F.col("_place") == 0)),
        ["country", "genre", "is_genre", "director"],
        rules.scale,
    )
    exact = mean_from_sums()
    compared = mean_from_sums(rules.director_digits)
    return sums.select(
        "country",
        "genre",
        "is_genre",
        "director",
        F.when(F.col("is_genre"), exact).otherwise(compared).alias("mean"),
    )

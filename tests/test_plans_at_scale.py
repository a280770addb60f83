"""What the plans do: shuffles, pushed filters, pruning, and large groups."""

from __future__ import annotations

import re
import pytest
from pyspark.sql import functions as F

from facetrank import plans
from facetrank.operators import argmax_ties, top_k, top_ties
from facetrank.plans.facts import credited_titles, rated_titles
from facetrank.schemas import BASICS, COUNTRIES, CREW, NAMES, RATINGS, TitleTables
from facetrank.sources import load_titles
from tests import micro
from tests.conftest import plan, rows

@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stored"))
    return load_titles(micro.micro_tables(spark), folder=folder, buckets=4, prefix="scale_")


def shuffles(text: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", re.sub(r"#\d+L?", "", text))


def test_star_joins_on_stored_tables_do_not_shuffle(no_broadcast, stored):
    assert shuffles(plan(rated_titles(stored, plans.STAGED))) == []
    assert shuffles(plan(credited_titles(stored, plans.STAGED))) == []


def test_report_shuffles_only_small_results(no_broadcast, stored):
    """Sums, winners, their names, the cut per country; none for the star join."""
    keys = shuffles(plan(plans.facet_report(stored)))
    assert keys and not any("titleId" in key for key in keys)


def test_exact_report_puts_no_genre_rows_under_one_key(no_broadcast, stored):
    """Rows are only joined on a director after genre rows, whose director is NULL, are set aside."""
    text = re.sub(r"#\d+L?", "", plan(plans.facet_report(stored, plans.EXACT)))
    assert "LeftOuter" not in text and "LeftSemi" in text


def test_sums_are_combined_before_the_shuffle(stored):
    assert "partial_sum" in plan(plans.facet_report(stored))


def test_filters_and_columns_reach_the_scan(stored):
    text = re.sub(r"#\d+L?", "", plan(plans.top_genre(stored)))
    assert "EqualTo(titleType,movie)" in text
    assert "GreaterThanOrEqual(startYear,2010)" in text
    assert "ReadSchema: struct<titleId:string,titleType:string,startYear:int,genres:array<string>>" in text
    assert "primaryTitle" not in text


def test_losers_are_dropped_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    assert plan(top_k(df, ["k"], [F.desc("v")], 3)).count("WindowGroupLimit") == 2
    assert "partial_max" in plan(top_ties(df, ["k"], "v")) and "Window" not in plan(top_ties(df, ["k"], "v"))


def skewed_tables(spark, n: int) -> TitleTables:
    """One country, one genre and one director hold over a third of all titles."""

    def hot(column, name, count):
        return F.when(column % 2 == 0, f"hot {name}").otherwise(
            F.concat(F.lit(f"{name} "), (column % count).cast("string"))
        )

    ids = spark.range(n).select(
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("titleId"), "id"
    )
    null = F.lit(None)
    year = (F.col("id") % 30 + 2000).cast("int")

    def typed(df, schema):
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])

    return TitleTables(
        basics=typed(
            ids.select(
                "titleId",
                F.lit("movie").alias("titleType"),
                null.alias("primaryTitle"),
                null.alias("originalTitle"),
                null.alias("isAdult"),
                year.alias("startYear"),
                null.alias("endYear"),
                null.alias("runtimeMinutes"),
                F.array(hot(F.col("id"), "genre", 20)).alias("genres"),
            ),
            BASICS,
        ),
        ratings=typed(
            ids.select(
                "titleId",
                (F.col("id") % 91 / 10.0 + 1).alias("rating"),
                (F.col("id") % 1000 + 1).alias("numVotes"),
            ),
            RATINGS,
        ),
        crew=typed(
            ids.select(
                "titleId",
                F.array(hot(F.col("id") + F.col("id") % 3, "director", 500)).alias("directors"),
                null.alias("writers"),
            ),
            CREW,
        ),
        names=typed(
            spark.range(500)
            .select(F.concat(F.lit("director "), F.col("id").cast("string")).alias("nameId"))
            .union(spark.range(1).select(F.lit("hot director")))
            .select(
                "nameId",
                F.upper("nameId").alias("primaryName"),
                null.alias("birthYear"),
                null.alias("deathYear"),
                null.alias("primaryProfession"),
                null.alias("knownForTitles"),
            ),
            NAMES,
        ),
        countries=typed(
            ids.select(
                "titleId",
                F.array(hot(F.col("id") + F.col("id") % 5, "country", 40)).alias("country"),
            ),
            COUNTRIES,
        ),
    )


def test_skewed_keys_give_the_same_result_by_every_route(spark, no_broadcast):
    tables = skewed_tables(spark, 20_000)
    final = ["country", "genre", "ranking", "best_directors"]
    staged = plans.best_director_for_genres(plans.top_genre(tables), plans.best_director(tables))
    assert rows(staged) == rows(plans.facet_report(tables), *final)
    means = plans.top_genre(tables).drop("ranking")
    assert rows(argmax_ties(means, ["country"], "weightedAveRating")) == rows(
        top_ties(means, ["country"], "weightedAveRating")
    )


def test_a_hot_group_sends_few_rows_through_the_shuffle(spark):
    """Rows written to shuffles, from the metrics of the finished plan."""
    tables = skewed_tables(spark, 50_000)
    report = plans.top_genre(tables)
    report.collect()
    sent = _rows_sent_by_country(report)
    groups, tasks = report.count(), 8
    assert sent and max(sent) <= groups * tasks < 50_000 / 3


def _rows_sent_by_country(df) -> list[int]:
    """Rows written by each exchange on (country, ...) of the finished plan."""
    found = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec" and "country" in node.outputPartitioning().toString():
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found

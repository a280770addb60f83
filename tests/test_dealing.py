"""Sums over three facets: what moves, and hot directors."""

from __future__ import annotations

import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from facetrank import plans
from facetrank.functions import weighted_mean
from facetrank.operators import deal, explode_facets, look_up
from facetrank.plans.facts import director_means, facet_means
from facetrank.workload import queries
from tests.conftest import plan, rows
from tests.test_plans_at_scale import skewed_tables

TITLES, DIRECTORS, ITEMS = 2_000, 1_000, 5
BY = ["country", "genre", "director"]


def wide_tables(spark):
    """Titles of five genres, five countries and two of many directors each."""
    tables = skewed_tables(spark, TITLES)
    number = F.substring("titleId", 2, 20).cast("int")

    def names(kind):
        return F.array(*[F.lit(f"{kind} {i}") for i in range(ITEMS)])

    def director(shift):
        return F.concat(F.lit("director "), (number * 7 + shift).try_cast("int") % DIRECTORS)

    return tables._replace(
        basics=tables.basics.withColumn("genres", names("genre")).withColumn("startYear", F.lit(2020)),
        countries=tables.countries.withColumn("country", names("country")),
        crew=tables.crew.withColumn("directors", F.array(director(0), director(501))),
    )


def rows_sent(df) -> int:
    """Rows written by the shuffles of a finished query, each shuffle once."""
    df.collect()
    sent = {}

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            sent[node.id()] = node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(sent.values())


def titles_of(tables):
    joined = tables.basics.join(tables.countries, "titleId").join(tables.crew, "titleId")
    return joined.join(tables.ratings, "titleId").select("genres", "country", "directors", "rating", "numVotes")


@pytest.fixture(scope="module")
def wide(spark):
    return wide_tables(spark)


@pytest.fixture(scope="module")
def joined(spark, wide, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("joined") / "titles")
    titles_of(wide).repartition(8).write.parquet(path)
    return spark.read.parquet(path)


def test_credits_move_before_facets_multiply_them(joined):
    means = weighted_mean(joined, BY, "rating", "numVotes", "mean", explode=queries.by_director, scale=6)
    credits, groups = 2 * TITLES, ITEMS * ITEMS * DIRECTORS
    # One by one, the combinations of a task hardly meet: 100,000 of them would move.
    assert rows_sent(means) <= credits + groups


def test_means_of_many_directors_are_exact(joined, wide):
    weights, products = {}, {}
    for row in joined.collect():
        for director in row.directors:
            for genre in row.genres:
                for country in row.country:
                    key = country, genre, director
                    weights[key] = weights.get(key, 0) + row.numVotes
                    products[key] = products.get(key, 0) + Fraction(str(row.rating)) * row.numVotes
    expected = sorted((*k, float(products[k]) / weights[k]) for k in weights)
    rules = plans.EXACT
    found = weighted_mean(joined, BY, "rating", "numVotes", "mean", explode=queries.by_director)
    assert sorted(map(tuple, found.collect())) == expected
    assert sorted(map(tuple, director_means(wide, rules).collect())) == expected
    both = facet_means(wide, rules).where(~F.col("is_genre")).select(*BY, "mean")
    assert sorted(map(tuple, both.collect())) == expected


def test_a_hot_director_is_split(spark):
    """One director of all titles: adaptive execution parts the key, sums stay the same."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    titles = spark.range(0, 200_000, numPartitions=8).select(
        F.array(F.concat(F.lit("hot "), (F.col("id") % 2).cast("string"))).alias("directors"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    before = spark.conf.get(name)
    spark.conf.set(name, "1MB")
    try:
        dealt = deal(explode_facets(titles, {"directors": "director"}), F.col("director"))
        counted = dealt.groupBy("director").agg(F.count("text").alias("n"))
        assert rows(counted) == [("hot 0", 100_000), ("hot 1", 100_000)]
        assert "skewed" in plan(counted)
    finally:
        spark.conf.set(name, before)


def test_own_places_of_genres_are_not_one_key(wide):
    """Rows without a director would all fall into one task; they are dealt by title."""
    text = plan(facet_means(wide, plans.EXACT))
    assert "xxhash64(coalesce(director" in re.sub(r"#\d+L?", "", text) and "hashpartitioning(_dealt" in text


def dealings(df) -> int:
    """How often a finished query dealt credits; a reused exchange is not counted again."""
    df.collect()
    final = re.sub(r"#\d+L?", "", plan(df)).split("== Initial Plan ==")[0]
    return len(re.findall(r"(?<!Reused)Exchange hashpartitioning\(_dealt", re.sub(r"ReusedExchange .*", "", final)))


def test_credits_are_dealt_once_for_maxima_and_winners(wide):
    assert dealings(plans.best_director(wide)) == 1
    # Once for the genres' own places, once for the directors.
    assert dealings(plans.facet_report(wide)) == 2


@pytest.mark.parametrize("read_twice", [False, True])
def test_look_up_finds_nothing_for_missing_keys(spark, read_twice):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "key string, n int")
    dim = spark.createDataFrame([("a", "Ann"), (None, "Nobody"), ("a", None)], "id string, name string")
    found = look_up(df, dim, ("key", "id"), {"name": "found_name"}, read_twice=read_twice)
    assert rows(found) == [("a", 1, "Ann"), ("a", 1, None)]
    kept = look_up(df, dim, ("key", "id"), {"name": "found_name"}, "left", read_twice)
    assert rows(kept) == [("a", 1, "Ann"), ("a", 1, None), ("b", 3, None), (None, 2, None)]


def test_a_missing_director_can_win_and_leaves_the_group_empty(wide):
    """The maxima count credits without a director, whose names are then not found."""
    missing = F.array(F.lit(None).cast("string"))
    title = wide.basics.limit(1).select("titleId").first().titleId
    one = F.col("titleId") == title
    tables = wide._replace(
        crew=wide.crew.withColumn("directors", F.when(one, missing).otherwise(F.col("directors"))),
        ratings=wide.ratings.withColumn("rating", F.when(one, 99.0).otherwise(F.col("rating"))),
        names=wide.names.unionByName(
            wide.names.limit(1).withColumn("nameId", F.lit(None).cast("string"))
        ),
    )
    assert plans.best_director(tables).collect() == []
    assert len(plans.best_director(wide).collect()) >= ITEMS * ITEMS

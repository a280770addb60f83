"""Every registered query against its SQL."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from facetrank.plans.rules import STAGED
from facetrank.workload.inputs import inputs
from facetrank.workload.oracle import SQL
from facetrank.workload.queries import registered
from tests.conftest import plan
from tests.oracle import compare, oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    return oracle(SF_DIR)


def test_every_query_has_sql():
    assert registered().keys() == SQL.keys()
    assert registered().keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("key", sorted(registered()))
def test_query_matches_sql(spark, db, key):
    df = contract.queries()[key](spark, SF_DIR)
    text = plan(df)
    for operator in ("CartesianProduct", "NestedLoop", "Python", "SinglePartition"):
        assert operator not in text
    problem = compare(df, db, contract.oracle_sql()[key])
    assert problem is None, problem


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["country", "genre", "ranking", "best_directors_text"]
    per_country = df.groupBy("country").count().collect()
    assert per_country and all(r["count"] <= STAGED.keep for r in per_country)


def by_country(df):
    groups = {}
    for row in df.collect():
        groups.setdefault(row["country"], []).append(row)
    return groups.values()


def test_ranks_start_at_one_and_dense_ranks_have_no_gaps(spark):
    for group in by_country(registered()["top_genre"](spark, SF_DIR)):
        ranks = sorted(r["ranking"] for r in group)
        assert ranks[0] == 1
        assert all(rank == ranks.index(rank) + 1 for rank in ranks)
    for group in by_country(registered()["facet_report"](spark, SF_DIR)):
        ranks = {r["ranking"] for r in group}
        assert ranks == set(range(1, len(ranks) + 1))


def test_means_lie_between_the_smallest_and_largest_rating(spark):
    low, high = (
        inputs(spark, SF_DIR).ratings.agg(F.min("rating"), F.max("rating")).first()
    )
    for key in ("weighted_mean", "weighted_mean_3keys"):
        means = [r["mean_rating"] for r in registered()[key](spark, SF_DIR).collect()]
        assert means and all(low <= m <= high for m in means)


def test_sorted_result_is_in_order(spark):
    got = [tuple(r) for r in registered()["sort_mixed"](spark, SF_DIR).collect()]
    assert got == sorted(got, key=lambda r: (r[0], -r[2], r[1]))

"""The title tables derived from order tables, on rows of their own."""

from __future__ import annotations

import datetime

import pytest

from facetrank.session import scratch_database
from facetrank.workload import inputs as derived
from tests.conftest import rows

LINES = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double,"
    " l_discount double, l_returnflag string"
)


@pytest.fixture
def tables(spark, tmp_path):
    """Part 1 and nation 8 are listed twice, supplier 3 has no nation, keys are missing."""
    day = datetime.datetime(1998, 3, 1)
    frames = {
        "nation": ([(7, "A"), (8, "B"), (8, "C")], "n_nationkey int, n_name string"),
        "supplier": (
            [(1, "s1", 7), (2, "s2", 8), (3, "s3", None), (None, "s", 7)],
            "s_suppkey bigint, s_name string, s_nationkey int",
        ),
        "part": ([(1, "X"), (1, "Y"), (2, "X"), (None, "Z")], "p_partkey bigint, p_type string"),
        "orders": (
            [(1, 5, "F", "p", day), (1, 5, "F", "p", day), (2, 6, "O", "q", day), (None, 7, "F", "r", day)],
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string,"
            " o_orderdate timestamp",
        ),
        "lineitem": (
            [
                (1, 1, 1, 10.0, 0.01, "R"),
                (1, 2, 2, 20.0, 0.06, "N"),
                (2, 2, 3, 30.0, None, "N"),
                (3, None, None, 40.0, 0.1, "R"),
                (None, 1, 1, 50.0, 0.02, "N"),
            ],
            LINES,
        ),
    }
    for name, (values, schema) in frames.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_inputs_count_lines_as_often_as_their_parts_suppliers_and_nations_are_listed(spark, tables):
    t = derived.inputs(spark, tables)
    # Title 1: part 1 twice (10 votes each, 1 %), nation 8 twice (20 votes each, 6 %).
    assert rows(t.ratings) == [("1", 3.5, 60), ("2", None, 30), ("3", 10.0, 40), (None, 2.0, 100)]
    assert rows(t.countries) == [("1", ("A", "B", "C")), (None, ("A",))]
    assert rows(t.crew) == [
        ("1", ("1", "2"), ("1",)), ("2", ("3",), ()), ("3", (), ()), (None, None, ())
    ]
    assert rows(t.basics, "titleId", "genres") == [
        ("1", ("X", "Y")), ("1", ("X", "Y")), ("2", ("X",)), (None, None)
    ]


def test_only_the_tables_that_are_read_are_derived(spark, tables):
    database = scratch_database(spark)
    before = {t.name for t in spark.catalog.listTables(database)}
    derived.inputs(spark, tables).countries.count()
    after = {t.name for t in spark.catalog.listTables(database)}
    assert [name.split("_")[0] for name in after - before] == ["countries"]


def test_buckets_grow_with_the_lines(spark, tables, monkeypatch):
    monkeypatch.setattr(derived, "source", lambda *_: spark.range(36_000_000))
    assert derived.bucket_count(spark, tables) >= 72


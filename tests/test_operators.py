from __future__ import annotations

import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from facetrank.functions import (
    json_field,
    missing_to_null,
    missing_words_to_null,
    split_field,
    strip_quotes,
    tokenize,
    weighted_mean,
)
from facetrank.operators import (
    argmax_ties,
    collect_sorted,
    distinct_values,
    drop_missing,
    explode_facets,
    group_max,
    keep_filled,
    look_up,
    one_row_per_key,
    rank_large_groups,
    rank_within,
    rerank_dense,
    star_join,
    tokenize_facets,
    top_k,
    top_ties,
    without_values,
)
from facetrank.schemas import BEST_DIRECTOR
from facetrank.sinks import append_rows, insert_overwrite, replace_view
from facetrank.sources import countries_from_responses, country_values
from tests.conftest import plan, rows


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"c {kind}")


def test_cells(spark):
    df = one_column(spark, ["\\N", "N/A", "", 'a"b"', None])
    assert rows(df.select(missing_to_null("c"))) == [("",), ("N/A",), ('a"b"',), (None,), (None,)]
    assert rows(df.select(missing_words_to_null("c")))[2:] == [(None,)] * 3
    assert ("ab",) in rows(df.select(strip_quotes("c")))
    lines = one_column(spark, ["x\ty", "x", ""])
    assert rows(lines.select(split_field("c", 2))) == [("y",), (None,), (None,)]
    assert rows(lines.select(split_field("c", 1))) == [("",), ("x",), ("x",)]
    tokens = one_column(spark, ["A,,B", ",", "", None])
    assert rows(tokens.select(tokenize("c"))) == [((),), ((),), (("A", "B"),), (None,)]
    bodies = one_column(spark, ['{"Country":"X"}', '{"Country":null}', "{}", "bad", '{"a.b":1}'])
    assert rows(bodies.select(json_field("c", "Country")))[0] == ("X",)
    assert ("1",) in rows(bodies.select(json_field("c", "a.b")))


def test_filters(spark):
    df = spark.createDataFrame(
        [("a", ["x"]), ("b", []), ("c", None), (None, ["y"])], "k string, v array<string>"
    )
    assert rows(keep_filled(df, "v"), "k") == [("a",), (None,)]
    assert rows(drop_missing(df, ["k", "v"]), "k") == [("a",), ("b",)]
    assert rows(without_values(df, "k", ["a", "b"]), "k") == [("c",)]


def test_star_join_and_lookup(spark):
    a = spark.createDataFrame([("1", "a"), ("2", "b"), (None, "c")], "k string, a string")
    b = spark.createDataFrame([("1", "x"), ("1", "y"), (None, "z")], "k string, b string")
    c = spark.createDataFrame([("1", "p")], "k string, c string")
    assert rows(star_join(a, b, c, key="k")) == [("1", "a", "x", "p"), ("1", "a", "y", "p")]
    dim = spark.createDataFrame([("a", "Ann"), ("b", None)], "id string, name string")
    assert rows(look_up(a, dim, ("a", "id"), {"name": "who"}), "a", "who") == [
        ("a", "Ann"),
        ("b", None),
    ]
    assert look_up(a, dim, ("a", "id"), {"name": "who"}, "left").count() == 3


def test_explode(spark):
    df = spark.createDataFrame(
        [("1", ["a", "a", "no"], ["x", "y"]), ("2", [], ["x"]), ("3", ["b"], None)],
        "k string, g array<string>, c array<string>",
    )
    got = explode_facets(df, {"g": "g", "c": "c"}, {"g": ["no"]})
    assert Counter(rows(got)) == {("1", "a", "x"): 2, ("1", "a", "y"): 2}
    text = spark.createDataFrame([("1", "a,,b", "x,")], "k string, g string, c string")
    assert rows(tokenize_facets(text, {"g": "g", "c": "c"})) == [("1", "a", "x"), ("1", "b", "x")]


def test_gather(spark):
    df = spark.createDataFrame(
        [("a", "y"), ("a", "x"), ("a", "x"), ("b", None)], "k string, v string"
    )
    assert rows(collect_sorted(df, ["k"], "v", "vs")) == [("a", ("x", "x", "y")), ("b", ())]
    assert rows(distinct_values(df, "v")) == [("x",), ("y",), (None,)]
    assert rows(group_max(df, ["k"], "v", "top")) == [("a", "y"), ("b", None)]


def exact_mean(pairs):
    weights = sum(w for _, w in pairs)
    total = sum(Fraction(str(v)) * w for v, w in pairs)
    return float(total) / float(weights) if weights else None


def test_weighted_mean_is_exact_and_order_free(spark):
    rng = random.Random(7)
    pairs = [(rng.randint(10, 100) / 10, rng.randint(1, 2_000_000)) for _ in range(5000)]
    data = [("a", *p) for p in pairs] + [("b", *p) for p in reversed(pairs)]
    df = spark.createDataFrame(data, "k string, v double, w int").repartition(7)
    got = dict(rows(weighted_mean(df, ["k"], "v", "w", "m")))
    assert got["a"] == got["b"] == exact_mean(pairs)
    assert min(p[0] for p in pairs) <= got["a"] <= max(p[0] for p in pairs)


def test_weighted_mean_never_rounds_the_values(spark):
    data = [("fine", 7.25, 1), ("fine", 7.31, 3)]
    data += [("large", 8_123_456.789012, 2_000_000_000), ("large", 0.000001, 1)] * 50
    frame = spark.createDataFrame(data, "k string, v double, w bigint")
    got = dict(rows(weighted_mean(frame, ["k"], "v", "w", "m")))
    assert got["fine"] == pytest.approx((7.25 + 3 * 7.31) / 4, rel=1e-15)
    assert got["large"] == pytest.approx(exact_mean([r[1:] for r in data if r[0] == "large"]), rel=1e-15)


@pytest.mark.parametrize("value", [1e300, 0.1234567, float("nan"), float("inf")])
def test_values_beyond_the_declared_decimals_are_errors(spark, value):
    for v, w in ((value, 2.0), (2.0, value)):
        frame = spark.createDataFrame([("a", v, w)], "k string, v double, w double")
        with pytest.raises(Exception, match="declared decimals"):
            weighted_mean(frame, ["k"], "v", "w", "m", scale=6).collect()


@pytest.mark.parametrize("value", [float("nan"), float("inf"), float("-inf")])
def test_numbers_without_a_sum_are_errors(spark, value):
    for v, w in ((value, 2.0), (2.0, value)):
        frame = spark.createDataFrame([("a", v, w)], "k string, v double, w double")
        with pytest.raises(Exception, match="not a finite number"):
            weighted_mean(frame, ["k"], "v", "w", "m").collect()


def _any_double(rng, kind):
    return [
        lambda: rng.choice([-1, 1]) * float(f"{rng.randrange(1, 10**15)}E{rng.randint(-290, 120)}"),
        lambda: 1 / 3,
        lambda: float(rng.randint(-(10**15), 10**15)) / 8,
        lambda: rng.randint(-50, 50) / 10,
        lambda: rng.choice([0.0, -0.0, 5e-324, 1.5, 0.4]),
    ][kind]()


def test_weighted_mean_of_any_doubles_is_that_of_the_exact_sums(spark):
    """Fractional weights, thirds, signs that cancel and 400 powers of ten in one group."""
    rng = random.Random(11)
    data = []
    for group in range(75):
        kinds = (group % 5, group // 5 % 5)
        data += [(group, *(_any_double(rng, k) for k in kinds)) for _ in range(rng.randint(1, 40))]
    cancelling = [(75, 1e30, 1.5), (75, 0.1, 0.5), (75, -1e30, 1.5), (75, 7.5, 0.25)]
    frame = spark.createDataFrame(data + cancelling, "k int, v double, w double")
    got = dict(rows(weighted_mean(frame.repartition(6), ["k"], "v", "w", "m")))
    again = dict(rows(weighted_mean(frame.repartition(3, "v"), ["k"], "v", "w", "m")))
    assert got == again and len(got) == 76
    for group in got:
        pairs = [(Fraction(repr(v)), Fraction(repr(w))) for k, v, w in data + cancelling if k == group]
        weights = sum(w for _, w in pairs)
        assert got[group] == (float(sum(v * w for v, w in pairs)) / float(weights) if weights else None)


def test_weights_that_are_not_whole_weigh_as_they_are(spark):
    frame = spark.createDataFrame([("a", 3.0, 1.5), ("a", 3.0, 0.4)], "k string, v double, w double")
    # Both sums are rounded once, 5.7 and 1.9.
    assert rows(weighted_mean(frame, ["k"], "v", "w", "m")) == [("a", 5.7 / 1.9)]
    whole = spark.createDataFrame([("a", 3, 2**62), ("a", 5, 2**62)], "k string, v int, w bigint")
    assert rows(weighted_mean(whole, ["k"], "v", "w", "m")) == [("a", 4.0)]


def test_missing_numbers_among_fractions(spark):
    data = [("a", None, 0.5), ("a", 1 / 3, None), ("a", 6.0, 0.5), ("b", None, 0.3), ("c", 1 / 3, None), ("d", 2.5, 0.0)]
    frame = spark.createDataFrame(data, "k string, v double, w double")
    assert dict(rows(weighted_mean(frame, ["k"], "v", "w", "m"))) == {"a": 3.0, "b": None, "c": None, "d": None}


def test_large_values_have_one_mean_in_every_order(spark):
    rng = random.Random(3)
    data = [(rng.randrange(10**14) / 10**6, rng.randrange(10**9)) for _ in range(400)]
    orders = [data, data[::-1], sorted(data), rng.sample(data, len(data))]
    frame = spark.createDataFrame(
        [(k, *pair) for k, order in enumerate(orders) for pair in order], "k int, v double, w bigint"
    )
    means = {m for _, m in rows(weighted_mean(frame.repartition(5), ["k"], "v", "w", "m"))}
    assert len(means) == 1


def test_weighted_mean_of_nothing(spark):
    data = [("zero", 5.0, 0), ("nulls", None, 3), ("mixed", None, 1), ("mixed", 6.0, 1)]
    df = spark.createDataFrame(data, "k string, v double, w int")
    got = dict(rows(weighted_mean(df, ["k"], "v", "w", "m")))
    # A missing value adds nothing to the sum; its weight still counts.
    assert got == {"zero": None, "nulls": None, "mixed": 3.0}


def test_weighted_mean_rounds_half_up(spark):
    df = spark.createDataFrame([("a", 7.2, 1), ("a", 7.3, 1)], "k string, v double, w int")
    assert rows(weighted_mean(df, ["k"], "v", "w", "m", digits=1)) == [("a", 7.3)]


SCORES = [("a", "p", 3.0), ("a", "q", 3.0), ("a", "r", 2.0), ("a", "s", 1.0), ("b", "p", None)]


def test_ranks(spark):
    df = spark.createDataFrame(SCORES, "k string, i string, v double")
    order = [F.desc("v")]
    ranked = rank_within(df, ["k"], "v")
    assert [r[3] for r in rows(ranked)] == [1, 1, 3, 4, 1]
    again = rerank_dense(ranked, ["k"], "ranking", "dense")
    assert [r[4] for r in rows(again)] == [1, 1, 2, 3, 1]
    assert rows(top_ties(df, ["k"], "v"), "i") == [("p",), ("p",), ("q",)]
    assert rows(argmax_ties(df, ["k"], "v"), "k", "i") == [("a", "p"), ("a", "q")]
    assert rows(top_k(df, ["k"], [*order, F.col("i")], 1), "k", "i") == [("a", "p"), ("b", "p")]


def test_tied_winners_of_one_group_are_in_many_partitions(spark):
    """100,000 rows tied for the first place, of a NULL group too."""
    for key in ("hot", None):
        df = spark.range(0, 100_000, 1, 8).select(
            F.lit(key).cast("string").alias("k"), F.col("id").alias("i"), F.lit(10.0).alias("v")
        )
        won = top_ties(df, ["k"], "v")
        assert won.count() == 100_000
        assert won.select(F.spark_partition_id()).distinct().count() > 1


@pytest.mark.parametrize("rows_per_range", [1, 2, 10, 1_000_000])
def test_rank_of_large_groups_by_brute_force(spark, rows_per_range):
    """One group and one value hold most rows; NULLs and a NULL group are there."""
    rng = random.Random(rows_per_range)
    data = [("hot", 5.0)] * 400
    data += [("hot", rng.choice([None, rng.gauss(0, 10), float(rng.randint(0, 9))])) for _ in range(800)]
    data += [(rng.choice(["a", "b", None]), round(rng.random(), 1)) for _ in range(300)]
    df = spark.createDataFrame([(*d, i) for i, d in enumerate(data)], "k string, v double, i int")
    groups = defaultdict(list)
    for key, value in data:
        groups[key].append(float("-inf") if value is None else value)
    expected = []
    for i, (key, value) in enumerate(data):
        mine = float("-inf") if value is None else value
        above = [v for v in groups[key] if v > mine]
        expected.append((i, len(above) + 1, len(set(above)) + 1))
    ranked = rank_large_groups(df, ["k"], "v", rows_per_range)
    got = ranked.select("i", "ranking", "dense_ranking").orderBy("i").collect()
    assert [tuple(r) for r in got] == expected
    assert ranked.columns == ["k", "v", "i", "ranking", "dense_ranking"]


def test_one_row_per_key(spark):
    df = spark.createDataFrame([("1", "b"), ("1", "a"), ("2", "c")], "k string, v string")
    assert rows(one_row_per_key(df, ["k"], [F.col("v")])) == [("1", "a"), ("2", "c")]


def test_insert_is_by_position_and_append_adds(spark, tmp_path):
    df = spark.createDataFrame([("P", "War", "Ann", 5)], "a string, b string, c string, rating int")
    for _ in range(2):
        stored = insert_overwrite(df, "positional", BEST_DIRECTOR, path=str(tmp_path / "p"))
    assert stored.schema == BEST_DIRECTOR
    assert rows(stored) == [("P", "War", "Ann", 5.0)]
    with pytest.raises(ValueError):
        insert_overwrite(df.drop("c"), "positional", BEST_DIRECTOR, path=str(tmp_path / "p"))
    for n in (1, 2):
        assert append_rows(df, "appended", path=str(tmp_path / "a")).count() == n
    spark.sql("DROP TABLE positional")
    spark.sql("DROP TABLE appended")


def test_view_is_replaced(spark):
    for n in (1, 2):
        assert rows(replace_view(spark.range(n), "some_view"))[-1] == (n - 1,)
    assert spark.catalog.dropTempView("some_view")


BODIES = [
    ("1", '{"Country":"USA, China"}'),
    ("2", '{"Country":"N/A"}'),
    ("3", '{"Country":""}'),
    ("4", "{}"),
    ("5", "not JSON"),
    ("6", None),
    ("7", '["Country"]'),
    ("8", '{"Country":null}'),
    ("9", '{"Country":"C\\u00f4te \\"d\\"","x":[1,{"y":2}]}'),
    ("10", '{"Country":"USA", broken'),
]


@pytest.mark.parametrize("trim, second", [(False, " China"), (True, "China")])
def test_countries_from_responses(spark, trim, second):
    got = countries_from_responses(
        spark.createDataFrame(BODIES, "titleId string, body string"), trim=trim
    )
    assert plan(got).count("Scan") == 1
    assert rows(got.where("not rejected"), "titleId", "countryText", "country") == [
        ("1", "USA, China", ("USA", second)),
        ("2", None, None),
        ("3", None, None),
        ("4", None, None),
        ("8", None, None),
        ("9", "Côte d", ("Côte d",)),
    ]
    bodies = dict(BODIES)
    assert rows(got.where("rejected"), "titleId", "body", "country") == [
        (i, bodies[i], None) for i in ("10", "5", "6", "7")
    ]
    assert got.where("not rejected and body is not null").count() == 0
    both = country_values(got), country_values(got, exploded=True, trim=True)
    assert [rows(x) for x in both] == [
        [("Côte d",), ("USA, China",)],
        [("China",), ("Côte d",), ("USA",)],
    ]

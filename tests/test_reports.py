from __future__ import annotations

from dataclasses import replace

import pytest

from facetrank import plans
from facetrank.plans import EXACT, STAGED
from facetrank.schemas import INPUTS
from facetrank.sinks import write_delimited
from tests import micro
from tests.conftest import rows

FINAL_COLUMNS = ["country", "genre", "ranking", "best_directors"]


@pytest.fixture(scope="module")
def tables(spark):
    return micro.micro_tables(spark)


def test_top_genre(tables):
    assert rows(plans.top_genre(tables)) == micro.TOP_GENRE


def test_best_director(tables):
    assert rows(plans.best_director(tables)) == micro.BEST_DIRECTOR


def test_best_director_for_genres(tables):
    merged = plans.best_director_for_genres(plans.top_genre(tables), plans.best_director(tables))
    assert merged.columns == FINAL_COLUMNS
    assert rows(merged) == micro.FINAL


def test_one_pass_report_equals_the_three_steps(tables):
    assert rows(plans.facet_report(tables), *FINAL_COLUMNS) == micro.FINAL
    batch = plans.facet_batch(tables)
    assert rows(batch.top_genre) == micro.TOP_GENRE
    assert rows(batch.best_director) == micro.BEST_DIRECTOR
    assert rows(batch.best_director_for_genres) == micro.FINAL


def test_exact_variant(tables):
    assert rows(plans.top_genres_with_directors(tables)) == micro.FINAL_EXACT
    merged = plans.best_director_for_genres(
        plans.top_genre(tables, EXACT), plans.best_director(tables, EXACT)
    )
    assert {r[:2] + r[3:] for r in rows(merged)} == {r[:2] + r[3:] for r in micro.FINAL_EXACT}


def genre_rows(tables, rules):
    return {r[:2]: r[2] for r in rows(plans.top_genre(tables, rules))}


def test_switch_titles_without_directors(tables):
    assert genre_rows(tables, STAGED)["China", "Romance"] == 7.5
    credited = replace(STAGED, genres_need_directors=True)
    assert genre_rows(tables, credited)["China", "Romance"] == 6.0
    final = {r[:2]: r[3] for r in rows(plans.facet_report(tables, credited))}
    assert final["China", "Romance"] == 6.0


def test_switch_rounding(tables):
    exact = replace(STAGED, director_digits=None)
    drama = [r for r in rows(plans.best_director(tables, exact)) if r[:2] == ("China", "Drama")]
    assert drama == [("China", "Drama", "Cy", 8.0)]


def test_switch_names_first(tables):
    named = replace(STAGED, named_directors_only=True)
    assert ("China", "Comedy", "Di", 7.0) in rows(plans.best_director(tables, named))
    assert ("China", "Comedy", 1, ("Di",)) in rows(
        plans.facet_report(tables, named), *FINAL_COLUMNS
    )


def test_switch_excluded_genre(tables):
    assert ("Japan", "movie") not in genre_rows(tables, STAGED)
    assert genre_rows(tables, replace(STAGED, excluded_genre=None))["Japan", "movie"] == 7.5


def test_unnamed_winner_keeps_the_group_but_not_the_list(spark):
    """A NULL name: the row stays in the ranking, the array leaves it out."""
    people = [("n9", None) if n == "n4" else (n, name) for n, name in micro.PEOPLE]
    tables = micro.micro_tables(spark, people=people)
    assert ("China", "Comedy", None, 9.5) in rows(plans.best_director(tables))
    comedy = ("China", "Comedy", 1, ())
    assert comedy in rows(plans.facet_report(tables), *FINAL_COLUMNS)
    assert comedy in rows(plans.facet_batch(tables).best_director_for_genres)
    exact = rows(plans.top_genres_with_directors(tables))
    assert not [r for r in exact if r[1] == "Comedy"]


def test_empty_items(spark):
    title = ("e1", "movie", 2015, ["", "War"], ["Peru"], ["", "n1"], 5.0, 10)
    tables = micro.micro_tables(spark, [title])
    assert [r[1] for r in rows(plans.top_genre(tables))] == ["", "War"]
    assert rows(plans.top_genres_with_directors(tables)) == [("Peru", "War", 5.0, ("Ann",))]


def test_repeated_rows_count_as_in_the_joins(spark):
    """Two crew rows multiply a title for its directors but not for its genres."""
    once = micro.micro_tables(spark)
    twice = once._replace(crew=once.crew.unionAll(once.crew))
    assert rows(plans.facet_batch(twice).top_genre) == micro.TOP_GENRE
    assert rows(plans.top_genre(twice)) == micro.TOP_GENRE
    assert rows(plans.facet_batch(twice).best_director) == rows(plans.best_director(twice))
    appended = once._replace(countries=once.countries.unionAll(once.countries))
    deduped = replace(STAGED, dedupe_countries=True)
    assert rows(plans.facet_report(appended, deduped), *FINAL_COLUMNS) == micro.FINAL


def test_zero_votes_give_no_mean(spark):
    title = ("z1", "movie", 2015, ["War"], ["Peru"], ["n1"], 5.0, 0)
    tables = micro.micro_tables(spark, [title])
    assert rows(plans.top_genre(tables)) == [("Peru", "War", None, 1)]


@pytest.mark.parametrize("partitions", ["1", "3", "13"])
def test_result_does_not_depend_on_partitioning(spark, tables, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        shuffled = type(tables)(*[t.repartition(int(partitions)) for t in tables])
        assert rows(plans.facet_report(shuffled), *FINAL_COLUMNS) == micro.FINAL
        assert rows(plans.top_genres_with_directors(shuffled)) == micro.FINAL_EXACT
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_batch_from_text_files(spark, tables, tmp_path):
    paths = {name: str(tmp_path / name) for name in INPUTS}
    for name, form in INPUTS.items():
        write_delimited(getattr(tables, name), paths[name], header=form.header)
    for _ in range(2):  # running it again replaces everything
        batch = plans.run_facet_batch(spark, paths, database="micro", buckets=3)
    assert rows(spark.table("micro.top_genre")) == micro.TOP_GENRE
    assert rows(spark.table("micro.best_director")) == micro.BEST_DIRECTOR
    assert rows(spark.table("micro.best_director_for_genres")) == micro.FINAL
    assert rows(batch.best_director_for_genres) == micro.FINAL
    exact = plans.run_facet_batch(spark, paths, database="micro_exact", buckets=3, rules=EXACT)
    assert {r[:2] + r[3:] for r in rows(exact.best_director_for_genres)} == {
        r[:2] + r[3:] for r in micro.FINAL_EXACT
    }
    spark.sql("DROP DATABASE micro CASCADE")
    spark.sql("DROP DATABASE micro_exact CASCADE")

"""Thirteen titles; each is there for one rule (see FIXTURES.md)."""

from __future__ import annotations

from facetrank.schemas import BASICS, COUNTRIES, CREW, NAMES, RATINGS, TitleTables

TITLES = [
    # id, type, year, genres, countries, directors, rating, votes
    ("t01", "movie", 2012, ["Drama", "Romance"], ["China", "Japan"], ["n1", "n2"], 6.0, 100),
    ("t02", "movie", 2015, ["Drama"], ["China"], ["n3"], 8.0, 50),
    ("t03", "movie", 2009, ["Drama"], ["China"], ["n1"], 9.9, 999),
    ("t04", "tvSeries", 2012, ["Drama"], ["China"], ["n1"], 9.9, 999),
    ("t05", "movie", 2018, ["Animation", "movie"], ["Japan"], ["n1"], 7.5, 10),
    ("t06", "movie", 2011, None, ["China"], ["n1"], 9.0, 10),
    ("t07", "movie", 2016, ["Romance"], ["China"], None, 9.0, 100),
    ("t08", "movie", 2013, ["Comedy"], ["China"], ["n9"], 9.5, 20),
    ("t09", "movie", 2014, ["Comedy"], ["China"], ["n4"], 7.0, 20),
    ("t10", "movie", None, ["Drama"], ["China"], ["n1"], 9.9, 5),
    ("t11", "movie", 2017, ["Drama"], ["China"], ["n2"], 8.0, 100),
    ("t12", "movie", 2019, ["Drama"], ["China"], ["n5"], 8.1, 1),
    ("t13", "movie", 2020, ["Drama"], ["China"], ["n5"], 7.9, 2),
]
PEOPLE = [("n1", "Ann"), ("n2", "Bo"), ("n3", "Cy"), ("n4", "Di"), ("n5", "Ed")]


def micro_tables(spark, titles=TITLES, people=PEOPLE) -> TitleTables:
    def frame(data, schema):
        return spark.createDataFrame(data, schema)

    return TitleTables(
        basics=frame([(t[0], t[1], None, None, None, t[2], None, None, t[3]) for t in titles], BASICS),
        ratings=frame([(t[0], t[6], t[7]) for t in titles], RATINGS),
        crew=frame([(t[0], t[5], None) for t in titles], CREW),
        names=frame([(n, name, None, None, None, None) for n, name in people], NAMES),
        countries=frame([(t[0], t[4]) for t in titles], COUNTRIES),
    )


TOP_GENRE = [
    ("China", "Comedy", 8.25, 1),
    ("China", "Drama", 7.20909090909091, 3),
    ("China", "Romance", 7.5, 2),
    ("Japan", "Animation", 7.5, 1),
    ("Japan", "Drama", 6.0, 2),
    ("Japan", "Romance", 6.0, 2),
]
BEST_DIRECTOR = [
    ("China", "Drama", "Cy", 8.0),
    ("China", "Drama", "Ed", 8.0),
    ("China", "Romance", "Ann", 6.0),
    ("China", "Romance", "Bo", 6.0),
    ("Japan", "Animation", "Ann", 7.5),
    ("Japan", "Drama", "Ann", 6.0),
    ("Japan", "Drama", "Bo", 6.0),
    ("Japan", "Romance", "Ann", 6.0),
    ("Japan", "Romance", "Bo", 6.0),
]
FINAL = [
    ("China", "Drama", 2, ("Cy", "Ed")),
    ("China", "Romance", 1, ("Ann", "Bo")),
    ("Japan", "Animation", 1, ("Ann",)),
    ("Japan", "Drama", 2, ("Ann", "Bo")),
    ("Japan", "Romance", 2, ("Ann", "Bo")),
]
FINAL_EXACT = [
    ("China", "Comedy", 8.25, ("Di",)),
    ("China", "Drama", 7.20909090909091, ("Cy",)),
    ("China", "Romance", 6.0, ("Ann", "Bo")),
    ("Japan", "Animation", 7.5, ("Ann",)),
    ("Japan", "Drama", 6.0, ("Ann", "Bo")),
    ("Japan", "movie", 7.5, ("Ann",)),
]

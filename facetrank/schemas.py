"""Declared schemas of the inputs and results.

Names, types and file layout are fixed values: they are the published file
formats and the result tables that readers already query.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

MISSING = "\\N"
FIELD_SEP = "\t"
ITEM_SEP = ","

_string = StringType()
_int = IntegerType()
_double = DoubleType()
_strings = ArrayType(StringType())


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


BASICS = _schema(
    titleId=_string,
    titleType=_string,
    primaryTitle=_string,
    originalTitle=_string,
    isAdult=_int,
    startYear=_int,
    endYear=_int,
    runtimeMinutes=_int,
    genres=_strings,
)
RATINGS = _schema(titleId=_string, rating=_double, numVotes=_int)
CREW = _schema(titleId=_string, directors=_strings, writers=_strings)
NAMES = _schema(
    nameId=_string,
    primaryName=_string,
    birthYear=_int,
    deathYear=_int,
    primaryProfession=_strings,
    knownForTitles=_strings,
)
COUNTRIES = _schema(titleId=_string, country=_strings)

TOP_GENRE = _schema(country=_string, genre=_string, weightedAveRating=_double, ranking=_int)
BEST_DIRECTOR = _schema(
    country=_string, genre=_string, director_name=_string, weighted_rating=_double
)
BEST_DIRECTOR_FOR_GENRES = _schema(
    country=_string, genre=_string, ranking=_int, best_directors=_strings
)
TOP_GENRES_WITH_DIRECTORS = _schema(
    country=_string, genre=_string, weightedAveRating=_double, topDirectors=_strings
)


class InputFormat(NamedTuple):
    schema: StructType
    header: bool
    key: str


INPUTS: dict[str, InputFormat] = {
    "basics": InputFormat(BASICS, True, "titleId"),
    "ratings": InputFormat(RATINGS, True, "titleId"),
    "crew": InputFormat(CREW, True, "titleId"),
    "names": InputFormat(NAMES, True, "nameId"),
    "countries": InputFormat(COUNTRIES, False, "titleId"),
}


class TitleTables(NamedTuple):
    """The five inputs of the ranking plans."""

    basics: DataFrame
    ratings: DataFrame
    crew: DataFrame
    names: DataFrame
    countries: DataFrame

"""Country table from landed web responses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetrank.functions.cells import (
    missing_words_to_null,
    split_items,
    strip_quotes,
)

COUNTRY_FIELD = "Country"


def countries_from_responses(
    responses: DataFrame,
    key: str = "titleId",
    body: str = "body",
    field: str = COUNTRY_FIELD,
    trim: bool = False,
) -> DataFrame:
    """(titleId, countryText, country, rejected, body) rows from (key, JSON body) rows.

    One row per response, from one scan and no shuffle. A missing, null, empty or
    N/A field gives a NULL country. A body that is not a JSON object is
    ``rejected``, keeps its key and body as they are and has no country; other
    rows have no body.
    """
    # One parse: NULL for a NULL body and for one that is not an object.
    parsed = responses.select(
        F.col(key).cast("string").alias("_own"),
        F.col(body).alias("_text"),
        F.from_json(body, "map<string,string>").alias("_fields"),
    )
    own, is_object = F.col("_own"), F.col("_fields").isNotNull()
    found = missing_words_to_null(strip_quotes(F.try_element_at("_fields", F.lit(field))))
    return (
        parsed.select(
            F.when(is_object, strip_quotes(own)).otherwise(own).alias("titleId"),
            F.when(is_object, found).alias("countryText"),
            (~is_object).alias("rejected"),
            F.when(~is_object, F.col("_text")).alias("body"),
        )
        .withColumn("country", split_items("countryText", trim=trim))
        .select("titleId", "countryText", "country", "rejected", "body")
    )


def country_values(countries: DataFrame, exploded: bool = False, trim: bool = False) -> DataFrame:
    """Distinct country texts, or with ``exploded`` the single countries in them.

    ``countries`` has a column ``countryText``; NULL texts hold no country.
    """
    texts = countries.select("countryText").where("countryText is not null").distinct()
    if not exploded:
        return texts.withColumnRenamed("countryText", "country")
    return texts.select(F.explode(split_items("countryText", trim=trim)).alias("country")).distinct()

"""The registered queries: (session, data folder) to DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from facetrank import plans
from facetrank.functions import (
    json_field,
    missing_to_null,
    split_field,
    strip_quotes,
    weighted_mean,
)
from facetrank.functions.means import PRODUCT, WEIGHT, sums_of, weigh
from facetrank.operators import (
    argmax_ties,
    collect_sorted,
    deal,
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
)
from facetrank.plans.facts import eligible_titles
from facetrank.schemas import (
    BASICS,
    BEST_DIRECTOR,
    COUNTRIES,
    CREW,
    INPUTS,
    TitleTables,
)
from facetrank.session import scratch_database, scratch_name, scratch_path
from facetrank.sinks import (
    append_rows,
    insert_overwrite,
    merge_rows,
    overwrite_table,
    replace_view,
    write_delimited,
)
from facetrank.sources import countries_from_responses, country_values, read_delimited, read_titles
from facetrank.workload.inputs import bucket_count, inputs, source

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the order tables that stand for the ones of the reports.
# Ratings have one decimal and votes are whole.
STAGED = replace(plans.STAGED, title_type="F", min_year=1998, excluded_genre="PROMO", scale=6)
EXACT = replace(plans.EXACT, title_type="F", min_year=1998, scale=6)

GROUP = ["country", "genre"]
TRIPLE = [*GROUP, "director"]

_queries: dict[str, Query] = {}


def query(key: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        _queries[key] = run
        return run

    return register


def registered() -> dict[str, Query]:
    return dict(_queries)


def joined_text(column: str, name: str, sep: str = "|") -> Column:
    return F.array_join(column, sep).alias(name)


def genre_titles(t: TitleTables) -> DataFrame:
    """(genres, country, rating, numVotes) of all eligible titles."""
    titles = star_join(
        eligible_titles(t.basics, STAGED),
        t.countries,
        t.ratings.select("titleId", "rating", "numVotes"),
        key="titleId",
    )
    return titles.drop("titleId")


def by_genre(titles: DataFrame) -> DataFrame:
    return explode_facets(titles, {"genres": "genre", "country": "country"}, {"genre": ["PROMO"]})


def director_titles(t: TitleTables) -> DataFrame:
    """(genres, country, directors, rating, numVotes) of all eligible titles."""
    titles = star_join(
        eligible_titles(t.basics, STAGED),
        t.countries,
        keep_filled(t.crew.select("titleId", "directors"), "directors"),
        t.ratings.select("titleId", "rating", "numVotes"),
        key="titleId",
    )
    return titles.drop("titleId")


def by_director(titles: DataFrame) -> DataFrame:
    return by_genre(deal(explode_facets(titles, {"directors": "director"}), F.col("director")))


def genre_means(t: TitleTables) -> DataFrame:
    return weighted_mean(
        genre_titles(t), GROUP, "rating", "numVotes", "mean_rating", explode=by_genre
    )


def director_means(t: TitleTables, digits: int | None = None) -> DataFrame:
    return weighted_mean(
        director_titles(t),
        TRIPLE,
        "rating",
        "numVotes",
        "mean_rating",
        digits=digits,
        explode=by_director,
    )


# Sources and sinks


@query("scan_tsv_header")
def scan_tsv_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "basics")
    write_delimited(inputs(spark, sf_dir).basics, path, header=True)
    return read_delimited(spark, path, BASICS, header=True).select(
        "titleId",
        "titleType",
        "primaryTitle",
        "originalTitle",
        "isAdult",
        "startYear",
        "endYear",
        joined_text("genres", "genres_text"),
    )


@query("scan_tsv_headerless")
def scan_tsv_headerless(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "countries")
    write_delimited(inputs(spark, sf_dir).countries, path)
    return read_delimited(spark, path, COUNTRIES, header=False).select(
        "titleId", joined_text("country", "country_text")
    )


@query("scan_array_column")
def scan_array_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "crew")
    write_delimited(inputs(spark, sf_dir).crew, path, header=True)
    return read_delimited(spark, path, CREW, header=True).select(
        "titleId",
        F.size("directors").alias("n_directors"),
        F.size("writers").alias("n_writers"),
        joined_text("writers", "writers_text"),
    )


@query("scan_lenient_types")
def scan_lenient_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short lines, extra fields and text in a number column."""
    key = F.col("o_orderkey").cast("string")
    year = F.year("o_orderdate").cast("string")
    priority = F.col("o_orderpriority")
    line = (
        F.when(F.col("o_orderstatus") == "O", key)
        .when(F.col("o_orderstatus") == "P", F.concat_ws("\t", key, priority, year, F.lit("more")))
        .otherwise(F.concat_ws("\t", key, F.substring_index(priority, "-", 1), year))
    )
    path = scratch_path(spark, "ragged")
    source(spark, sf_dir, "orders").select(line.alias("line")).write.text(path)
    schema = StructType(
        [
            StructField("titleId", StringType()),
            StructField("priority", IntegerType()),
            StructField("startYear", IntegerType()),
        ]
    )
    return read_delimited(spark, path, schema, header=False)


@query("scan_quoted")
def scan_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted fields that hold the separator and quotes; short lines."""
    last = F.when(F.col("s_suppkey") % 3 != 0, F.lit("\t\"last\"")).otherwise(F.lit(""))
    line = F.concat(
        F.col("s_suppkey").cast("string"),
        F.lit('\t"'),
        F.col("s_name"),
        F.lit('"\t"a\t""b"""'),
        last,
    )
    path = scratch_path(spark, "quoted")
    source(spark, sf_dir, "supplier").select(line.alias("line")).write.text(path)
    key = source(spark, sf_dir, "supplier").schema["s_suppkey"].dataType
    schema = StructType(
        [StructField("s_suppkey", key)]
        + [StructField(name, StringType()) for name in ("name", "marked", "last")]
    )
    return read_delimited(spark, path, schema, header=False, quoted=True)


@query("scan_blank_lines")
def scan_blank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty lines and lines of separators or blanks are rows."""
    kind = F.col("s_suppkey") % 5
    line = (
        F.when(kind == 1, "")
        .when(kind == 2, "\t")
        .when(kind == 3, " ")
        .otherwise(F.concat_ws("\t", "s_name", F.col("s_nationkey").cast("string")))
    )
    path = scratch_path(spark, "blank")
    source(spark, sf_dir, "supplier").select(line.alias("line")).write.text(path)
    schema = StructType([StructField(name, StringType()) for name in ("name", "nation")])
    return read_delimited(spark, path, schema, header=False)


@query("scan_header_override")
def scan_header_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A country file that has a header, against its usual form."""
    paths = dict.fromkeys(INPUTS, scratch_path(spark, "with_header"))
    write_delimited(inputs(spark, sf_dir).countries, paths["countries"], header=True)
    tables = read_titles(spark, paths, {"countries": True})
    return tables.countries.select("titleId", joined_text("country", "country_text"))


@query("scan_trimmed_items")
def scan_trimmed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "spaced")
    spaced = F.concat(F.lit(" "), F.array_join("country", " ,  "), F.lit(" "))
    write_delimited(inputs(spark, sf_dir).countries.select("titleId", spaced.alias("c")), path)
    return read_delimited(spark, path, COUNTRIES, header=False, trim_items=True).select(
        "titleId", joined_text("country", "country_text")
    )


@query("null_marker")
def null_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.when(F.col("c_acctbal") < 0, "\\N").otherwise(F.col("c_mktsegment"))
    raw = source(spark, sf_dir, "customer").select("c_custkey", segment.alias("segment"))
    clean = raw.withColumn("segment", missing_to_null("segment"))
    return drop_missing(clean, ["segment"])


@query("load_overwrite")
def load_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load replaces the rows of the first."""
    crew = inputs(spark, sf_dir).crew
    database, table = scratch_database(spark), scratch_name("crew")
    stale = crew.select(F.concat(F.lit("old"), "titleId").alias("titleId"), "directors", "writers")
    for rows in (stale, crew):
        stored = overwrite_table(rows, table, database, bucket_by="titleId")
    return stored.select("titleId", joined_text("directors", "directors_text"))


@query("insert_overwrite")
def insert_overwrite_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    winners = plans.best_director(inputs(spark, sf_dir), STAGED)
    # Worked out once, for both inserts.
    path = scratch_path(spark, "winners")
    winners.write.parquet(path)
    by_other_name = spark.read.schema(winners.schema).parquet(path).withColumnRenamed(
        "weighted_rating", "rating"
    )
    stale = by_other_name.withColumn("director_name", F.lit("old"))
    database, table = scratch_database(spark), scratch_name("best_director")
    for rows in (stale, by_other_name):
        stored = insert_overwrite(rows, table, BEST_DIRECTOR, database)
    return stored


@query("store_rejects")
def store_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies with tabs, line breaks and quotes, through a file and back."""
    torn = F.concat("body", F.lit('\tx\n"y"'))
    rows = countries_from_responses(
        responses(spark, sf_dir).withColumn(
            "body", F.when(F.col("body").startswith("error"), torn).otherwise(F.col("body"))
        )
    )
    path = scratch_path(spark, "rejects")
    rows.where("rejected").select("titleId", "body").write.json(path)
    return spark.read.schema("titleId string, body string").json(path)


@query("replace_view")
def replace_view_of_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second view of the same name replaces the first."""
    titles = inputs(spark, sf_dir).basics.select("titleId", "titleType")
    name = scratch_name("titles")
    replace_view(titles, name)
    return replace_view(titles.where(F.col("titleType") == "F"), name)


@query("store_tsv_array")
def store_tsv_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "report")
    report = plans.top_genres_with_directors(inputs(spark, sf_dir), EXACT)
    write_delimited(report, path)
    return spark.read.text(path).select(
        split_field("value", 1).alias("country"),
        split_field("value", 2).alias("genre"),
        split_field("value", 3).cast("double").alias("mean_rating"),
        split_field("value", 4).alias("directors_text"),
    )


@query("append_dedupe")
def append_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    countries = inputs(spark, sf_dir).countries
    database, table = scratch_database(spark), scratch_name("appended")
    append_rows(countries, table, database)
    twice = append_rows(countries, table, database)
    return one_row_per_key(twice, ["titleId"], [F.col("country")]).select(
        "titleId", joined_text("country", "country_text")
    )


@query("append_merge")
def append_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles come twice with other countries, and then once more: the first stay."""
    countries = inputs(spark, sf_dir).countries
    number = F.col("titleId").cast("bigint")
    first = countries.where(number % 3 != 0)
    second = countries.withColumn("country", F.array(F.lit("second")))
    database, table = scratch_database(spark), scratch_name("merged")
    for rows in (first, second, first.unionByName(second)):
        merged = merge_rows(rows, table, ["titleId"], [F.size("country"), F.col("country")], database)
    return merged.select("titleId", joined_text("country", "country_text"))


# Projections and filters


@query("project_rename")
def project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs(spark, sf_dir).basics.select(
        F.col("titleId").alias("title_id"),
        F.col("titleType").alias("kind"),
        F.col("startYear").alias("year"),
    )


@query("filter_star")
def filter_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    basics = inputs(spark, sf_dir).basics
    return basics.where((F.col("titleType") == "F") & (F.col("startYear") >= 1998)).select(
        "titleId", "titleType", "startYear", "primaryTitle"
    )


@query("filter_not_null")
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    basics = inputs(spark, sf_dir).basics
    return drop_missing(basics, ["titleId", "startYear", "genres"]).select("titleId", "startYear")


@query("filter_nonempty_array")
def filter_nonempty_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_filled(inputs(spark, sf_dir).crew, "writers").select(
        "titleId", F.size("writers").alias("n_writers")
    )


@query("exclude_facet_value")
def exclude_facet_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    basics = inputs(spark, sf_dir).basics.select("titleId", "genres")
    return explode_facets(basics, {"genres": "genre"}, {"genre": ["PROMO"]})


# Joins


@query("star_join_3")
def star_join_3(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = inputs(spark, sf_dir)
    return star_join(
        t.basics.select("titleId", "titleType", "startYear", "genres"),
        t.countries,
        t.ratings,
        key="titleId",
    ).select(
        "titleId",
        "titleType",
        "startYear",
        "rating",
        "numVotes",
        joined_text("genres", "genres_text"),
        joined_text("country", "country_text"),
    )


@query("star_join_4")
def star_join_4(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = inputs(spark, sf_dir)
    return star_join(
        t.basics.select("titleId", "genres"), t.countries, t.crew, t.ratings, key="titleId"
    ).select(
        "titleId",
        "rating",
        "numVotes",
        joined_text("genres", "genres_text"),
        joined_text("country", "country_text"),
        joined_text("directors", "directors_text"),
    )


@query("dim_lookup")
def dim_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = inputs(spark, sf_dir)
    credits = explode_facets(t.crew.select("titleId", "directors"), {"directors": "director"})
    return look_up(credits, t.names, ("director", "nameId"), {"primaryName": "director_name"})


@query("join_two_keys")
def join_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = inputs(spark, sf_dir)
    best = group_max(director_means(t), GROUP, "mean_rating", "best_mean")
    return genre_means(t).join(best, GROUP)


@query("argmax_ties")
def argmax_ties_of_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return argmax_ties(director_means(inputs(spark, sf_dir)), GROUP, "mean_rating")


# Generators


@query("explode_one")
def explode_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_facets(inputs(spark, sf_dir).countries, {"country": "country"})


@query("explode_two")
def explode_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = inputs(spark, sf_dir)
    titles = star_join(t.basics.select("titleId", "genres"), t.countries, key="titleId")
    return explode_facets(titles, {"genres": "genre", "country": "country"})


@query("explode_three")
def explode_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = inputs(spark, sf_dir)
    titles = star_join(
        t.basics.select("titleId", "genres"),
        t.countries,
        t.crew.select("titleId", "directors"),
        key="titleId",
    )
    return explode_facets(
        titles, {"genres": "genre", "country": "country", "directors": "director"}
    )


@query("tokenize_flatten")
def tokenize_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two delimited cells of a row: the product of their tokens."""
    parts = source(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("word"), F.col("p_brand").alias("brand_word")
    )
    words = tokenize_facets(parts, {"word": "word"}, sep=" ")
    return tokenize_facets(words, {"brand_word": "brand_word"}, sep="#")


# Aggregations


@query("sum_product")
def sum_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = weigh(genre_titles(inputs(spark, sf_dir)), "rating", "numVotes")
    sums = sums_of(by_genre(titles), ["country"])
    return sums.select(
        "country",
        F.col(WEIGHT).cast("bigint").alias("votes"),
        F.col(PRODUCT).alias("rating_votes"),
    )


@query("weighted_mean")
def weighted_mean_2keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genre_means(inputs(spark, sf_dir))


@query("weighted_mean_rounded")
def weighted_mean_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return director_means(inputs(spark, sf_dir), digits=1)


@query("weighted_mean_3keys")
def weighted_mean_3keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return director_means(inputs(spark, sf_dir))


@query("weighted_mean_fractional")
def weighted_mean_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights that are not whole and values of more than six decimals."""
    lines = source(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.round(F.col("l_extendedprice") / 3, 9).alias("value"),
        (F.col("l_discount") / 64).alias("weight"),
    )
    return weighted_mean(lines, ["l_suppkey"], "value", "weight", "mean_value")


@query("group_max")
def group_max_of_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_max(director_means(inputs(spark, sf_dir)), GROUP, "mean_rating", "best_mean")


@query("director_lists")
def director_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    winners = plans.best_director(inputs(spark, sf_dir), STAGED)
    lists = collect_sorted(winners, GROUP, "director_name", "directors")
    return lists.select(*GROUP, joined_text("directors", "directors_text"))


@query("distinct_values")
def distinct_values_of_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of countries is one value, as in the text it came from."""
    text = inputs(spark, sf_dir).countries.select(joined_text("country", "country_text", ", "))
    return distinct_values(text, "country_text")


@query("country_values")
def country_values_of_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The single countries out of the list texts."""
    text = inputs(spark, sf_dir).countries.select(joined_text("country", "countryText", ", "))
    return country_values(text, exploded=True, trim=True)


# Ranking


@query("rank_within")
def rank_within_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_within(genre_means(inputs(spark, sf_dir)), ["country"], "mean_rating")


@query("rank_within_large")
def rank_within_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks of all (genre, director) rows of a country: groups without a size bound."""
    means = director_means(inputs(spark, sf_dir), digits=1)
    ranked = rank_large_groups(means, ["country"], "mean_rating")
    return ranked.select(*TRIPLE, "mean_rating", "ranking", "dense_ranking")


@query("rank_within_ranges")
def rank_within_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks of all lines by price, in three groups cut into ranges of few values."""
    lines = source(spark, sf_dir, "lineitem").select(
        F.pmod("l_suppkey", F.lit(3)).cast("int").alias("third"), "l_extendedprice"
    )
    ranked = rank_large_groups(lines, ["third"], "l_extendedprice", rows_per_range=100)
    return ranked.select("third", "l_extendedprice", "ranking", "dense_ranking")


@query("top_ties")
def top_ties_of_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = director_means(inputs(spark, sf_dir), digits=1)
    return top_ties(means, GROUP, "mean_rating")


@query("rerank_dense")
def rerank_dense_of_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = genre_means(inputs(spark, sf_dir)).withColumn(
        "mean_rating", F.round("mean_rating", 0)
    )
    ranked = rank_within(means, ["country"], "mean_rating", "first_rank")
    return rerank_dense(ranked, ["country"], "first_rank").drop("mean_rating")


@query("top_k_rows")
def top_k_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = rank_within(genre_means(inputs(spark, sf_dir)), ["country"], "mean_rating")
    kept = top_k(ranked, ["country"], [F.col("ranking"), F.col("genre")], 3)
    return kept.select("country", "genre", "ranking")


@query("top_k_by_value")
def top_k_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = genre_means(inputs(spark, sf_dir))
    return top_k(means, ["country"], [F.desc("mean_rating"), F.col("genre")], 3)


@query("sort_mixed")
def sort_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = genre_means(inputs(spark, sf_dir))
    return means.orderBy("country", F.desc("mean_rating"), "genre")


@query("sort_two_keys")
def sort_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = plans.top_genre(inputs(spark, sf_dir), STAGED)
    return ranked.select("country", "genre", "ranking").orderBy("country", "genre")


# Landed responses


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies with a country, without one, with a word for "none", and broken ones."""
    kind, props = F.col("event_type"), F.col("props")
    body = (
        F.when(
            kind == "purchase",
            F.concat(
                F.lit('{"Title":"x","Country":"U'),
                F.col("user_id").cast("string"),
                F.lit(', \\"V'),
                json_field("props", "k"),
                F.lit('\\""}'),
            ),
        )
        .when(kind == "view", '{"Country":"N/A"}')
        .when(kind == "signup", '{"Country":""}')
        .when(kind == "error", F.concat(F.lit("error "), props))
        .otherwise(props)
    )
    return source(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("titleId"), body.alias("body")
    )


@query("strip_quotes")
def strip_quotes_of_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = source(spark, sf_dir, "events")
    return events.select("event_id", strip_quotes("props").alias("bare_props"))


@query("split_field")
def split_field_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First field of every line of a text file; a header would count as a line."""
    path = scratch_path(spark, "lines")
    write_delimited(inputs(spark, sf_dir).basics.select("titleId", "primaryTitle"), path)
    return spark.read.text(path).select(split_field("value", 1).alias("titleId"))


@query("json_field")
def json_field_of_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses(spark, sf_dir).select(
        "titleId", json_field("body", "Country").alias("raw_country")
    )


@query("country_enrichment")
def country_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return countries_from_responses(responses(spark, sf_dir)).select(
        "titleId",
        "countryText",
        F.size("country").alias("n_countries"),
        F.element_at("country", -1).alias("last_country"),
        "rejected",
    )


# Reports


@query("top_genre")
def top_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.top_genre(inputs(spark, sf_dir), STAGED)


@query("top_genre_credited")
def top_genre_credited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only titles with directors count; tokens of all genres."""
    return plans.top_genre(inputs(spark, sf_dir), EXACT)


@query("best_director")
def best_director(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.best_director(inputs(spark, sf_dir), STAGED)


@query("best_director_unrounded")
def best_director_unrounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.best_director(inputs(spark, sf_dir), EXACT)


def _with_text(report: DataFrame) -> DataFrame:
    return report.select(
        *GROUP, "ranking", joined_text("best_directors", "best_directors_text")
    )


@query("best_director_for_genres")
def best_director_for_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = inputs(spark, sf_dir)
    return _with_text(
        plans.best_director_for_genres(
            plans.top_genre(t, STAGED), plans.best_director(t, STAGED), STAGED.keep
        )
    )


@query("facet_report")
def facet_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result in one pass over the inputs."""
    return _with_text(plans.facet_report(inputs(spark, sf_dir), STAGED))


@query("facet_batch")
def facet_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From text files to the stored result."""
    t = inputs(spark, sf_dir)
    folder, database = scratch_path(spark, "batch"), scratch_name("batch")
    paths = {name: f"{folder}/text/{name}" for name in INPUTS}
    for name, form in INPUTS.items():
        write_delimited(getattr(t, name), paths[name], header=form.header)
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{folder}/database'")
    batch = plans.run_facet_batch(
        spark, paths, database, buckets=bucket_count(spark, sf_dir), rules=STAGED
    )
    return _with_text(batch.best_director_for_genres)


@query("facet_batch_exact")
def facet_batch_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = plans.top_genres_with_directors(inputs(spark, sf_dir), EXACT)
    return report.select(
        *GROUP, "weightedAveRating", joined_text("topDirectors", "top_directors_text")
    )

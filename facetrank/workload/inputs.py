"""The five title inputs, derived from the order tables.

Orders are titles, part types genres, supplier nations countries and suppliers
directors. Some titles have no crew, some directors no name row and some a NULL
name, so that the variants of the reports differ. Each table is derived from the
lines by itself, with the columns it needs, and stored in the shared folder when
it is first used in an application; every query then reads the stored table.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from facetrank.schemas import INPUTS, TitleTables
from facetrank.session import scratch_database
from facetrank.sinks.tables import overwrite_table

# Lines of a bucket. Its titles are multiplied by their genres, countries and directors
# in one task, so this bounds a task's memory whatever the number of lines.
ROWS_PER_BUCKET = 500_000
MIN_BUCKETS = 8

# Which keys lack something.
NO_CREW, NO_NAME_ROW, NULL_NAME = 11, 7, 13

def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _titles(spark: SparkSession, sf_dir: str, name: str, key: str, buckets: int, *columns) -> DataFrame:
    """Rows of a table with their title, dealt as the buckets are."""
    title = F.col(key).cast("string").alias("titleId")
    return source(spark, sf_dir, name).select(title, *columns).repartition(buckets, "titleId")


def _names_of(column: Column) -> Column:
    return F.sort_array(F.collect_set(column))


def _repeated(rows: DataFrame, key: str) -> DataFrame:
    """Keys that are there more than once, and how often (``rows`` has a number ``_n`` each)."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("_n").alias("_n")).where("_n > 1")


def genres(spark: SparkSession, sf_dir: str, buckets: int) -> DataFrame:
    """(titleId, genres) of every title that has lines.

    Parts grow with the lines, so they are merged and not broadcast; of the lines
    only the two keys move.
    """
    parts = source(spark, sf_dir, "part").select("p_partkey", "p_type")
    lines = source(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("titleId"), "l_partkey"
    )
    typed = lines.join(parts.hint("merge"), F.col("l_partkey") == F.col("p_partkey"), "left")
    return (
        typed.select("titleId", "p_type")
        .repartition(buckets, "titleId")
        .groupBy("titleId")
        .agg(_names_of(F.col("p_type")).alias("genres"))
    )


def basics(spark: SparkSession, sf_dir: str, buckets: int) -> DataFrame:
    orders = _titles(
        spark,
        sf_dir,
        "orders",
        "o_orderkey",
        buckets,
        F.col("o_orderstatus").alias("titleType"),
        F.col("o_orderpriority").alias("primaryTitle"),
        F.col("o_custkey").cast("string").alias("originalTitle"),
        F.lit(0).alias("isAdult"),
        F.year("o_orderdate").alias("startYear"),
        F.lit(None).cast("int").alias("endYear"),
        F.lit(None).cast("int").alias("runtimeMinutes"),
    )
    return orders.join(genres(spark, sf_dir, buckets).hint("merge"), "titleId", "left")


def ratings(spark: SparkSession, sf_dir: str, buckets: int) -> DataFrame:
    """Mean discounts and summed quantities of each title.

    A line counts as often as its part, its supplier and the supplier's nation are
    listed. Keys listed twice are looked for first; where there are none, as in
    clean tables, the lines are summed as they are.
    """
    nations = source(spark, sf_dir, "nation").groupBy("n_nationkey").agg(F.count(F.lit(1)).alias("_nations"))
    suppliers = (
        source(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select("s_suppkey", F.coalesce("_nations", F.lit(1)).alias("_n"))
    )
    parts = source(spark, sf_dir, "part").select("p_partkey", F.lit(1).cast("bigint").alias("_n"))
    lines = source(spark, sf_dir, "lineitem").withColumn("_times", F.lit(1).cast("bigint"))
    for rows, own, key in ((parts, "p_partkey", "l_partkey"), (suppliers, "s_suppkey", "l_suppkey")):
        twice = _repeated(rows, own)
        if not twice.isEmpty():
            lines = lines.join(twice, F.col(key) == F.col(own), "left")
            lines = lines.withColumn("_times", F.col("_times") * F.coalesce("_n", F.lit(1))).drop(own, "_n")
    points = F.round(F.col("l_discount") * 100).cast("long") * F.col("_times")
    # Sums are small, so they are taken before the rows are dealt.
    summed = lines.groupBy(F.col("l_orderkey").cast("string").alias("titleId")).agg(
        F.sum(F.col("l_quantity").cast("long") * F.col("_times")).alias("numVotes"),
        F.sum(points).alias("points"),
        F.sum("_times").alias("lines"),
    )
    # Mean discount in percent, rounded half up to one decimal in integers.
    tenths = F.expr("(20 * points + lines) div (2 * lines)")
    return summed.select("titleId", (tenths / F.lit(10.0)).alias("rating"), "numVotes").repartition(
        buckets, "titleId"
    )


def crew(spark: SparkSession, sf_dir: str, buckets: int) -> DataFrame:
    """Suppliers of each title, and those of its returned lines; as numbers until the end."""

    def ids(numbers: Column) -> Column:
        return F.sort_array(F.transform(F.collect_set(numbers), lambda n: n.cast("string")))

    lines = _titles(spark, sf_dir, "lineitem", "l_orderkey", buckets, "l_suppkey", "l_returnflag")
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_suppkey"))
    uncredited = F.pmod(F.col("titleId").cast("bigint"), F.lit(NO_CREW)) == 0
    found = lines.groupBy("titleId").agg(ids(F.col("l_suppkey")).alias("directors"), ids(returned).alias("writers"))
    return found.select("titleId", F.when(~uncredited, F.col("directors")).alias("directors"), "writers")


def names(spark: SparkSession, sf_dir: str, buckets: int) -> DataFrame:
    key = F.col("s_suppkey")
    no_names = F.lit(None).cast("array<string>")
    return (
        source(spark, sf_dir, "supplier")
        .where(key % NO_NAME_ROW != 0)
        .select(
            key.cast("string").alias("nameId"),
            F.when(key % NULL_NAME != 0, F.col("s_name")).alias("primaryName"),
            F.lit(None).cast("int").alias("birthYear"),
            F.lit(None).cast("int").alias("deathYear"),
            no_names.alias("primaryProfession"),
            no_names.alias("knownForTitles"),
        )
        .repartition(buckets, "nameId")
    )


def countries(spark: SparkSession, sf_dir: str, buckets: int) -> DataFrame:
    """Nations of each title's suppliers; titles without any are left out."""
    nations = source(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    suppliers = source(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    lines = source(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("titleId"), "l_suppkey"
    )
    return (
        lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .where("n_name is not null")
        .select("titleId", "n_name")
        .repartition(buckets, "titleId")
        .groupBy("titleId")
        .agg(_names_of(F.col("n_name")).alias("country"))
    )


DERIVED = {"basics": basics, "ratings": ratings, "crew": crew, "names": names, "countries": countries}


def bucket_count(spark: SparkSession, sf_dir: str) -> int:
    """Buckets for the title tables, by the number of lines (read from file footers)."""
    rows = source(spark, sf_dir, "lineitem").count()
    return max(MIN_BUCKETS, -(-rows // ROWS_PER_BUCKET))


class LazyTitles:
    """The inputs, as :class:`TitleTables`; each is derived and stored when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir
        self._buckets = bucket_count(spark, sf_dir)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in INPUTS:
            raise AttributeError(name)
        table = store_input(self._spark, self._sf_dir, name, self._buckets)
        setattr(self, name, table)
        return table


def store_input(spark: SparkSession, sf_dir: str, name: str, buckets: int) -> DataFrame:
    """Derive and store one input, bucketed by its join key.

    The table is replaced; frames of an earlier call go on reading its version.
    """
    mark = zlib.crc32(f"{spark.sparkContext.applicationId} {sf_dir}".encode())
    return overwrite_table(
        DERIVED[name](spark, sf_dir, buckets),
        f"{name}_{mark:08x}",
        scratch_database(spark),
        bucket_by=INPUTS[name].key,
        buckets=buckets,
        # Derived rows are dealt as the buckets are.
        clustered=True,
    )


def store_inputs(spark: SparkSession, sf_dir: str) -> TitleTables:
    """Derive and store all inputs."""
    buckets = bucket_count(spark, sf_dir)
    return TitleTables(**{name: store_input(spark, sf_dir, name, buckets) for name in INPUTS})


_stored: dict[tuple[str, str], LazyTitles] = {}


def inputs(spark: SparkSession, sf_dir: str) -> LazyTitles:
    """The stored inputs; each is derived on first use in an application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        _stored[key] = LazyTitles(spark, sf_dir)
    return _stored[key]

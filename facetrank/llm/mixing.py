"""Mixing sources to target weights by Poisson replication.

A source whose texts should be seen ``rate`` times on average gives each of its
documents a Poisson count with that mean. The count is the inverse distribution
function at a uniform number that a hash of seed and doc_id gives, so it needs no
state, is the same on every run, and does not depend on how rows are dealt out.
Documents are exploded by their counts and all copies are put in the order of a
second hash. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetrank.llm.common import stored

SEED = 20_240
TEMPERATURE = 0.7


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) with 52 random bits from the md5 of the joined parts."""
    digits = F.substring(F.md5(F.concat_ws("/", *parts).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 52))


def poisson_distribution(rate: Column) -> Column:
    """Array of P(count <= k) for k = 0, 1, ... up to where no 52-bit number reaches.

    Terms are carried as logarithms, so large rates do not underflow.
    """
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    start = F.struct((-rate).alias("log_term"), F.array(F.exp(-rate)).alias("below"))

    def step(state, k):
        log_term = state["log_term"] + F.log(rate / k)
        return F.struct(
            log_term.alias("log_term"),
            F.concat(
                state["below"], F.array(F.element_at(state["below"], -1) + F.exp(log_term))
            ).alias("below"),
        )

    terms = F.aggregate(F.sequence(F.lit(1), last), start, step, lambda state: state["below"])
    return F.when(rate > 0, terms)


def source_rates(
    docs: DataFrame, weights: DataFrame | None = None, temperature: float = TEMPERATURE
) -> DataFrame:
    """``(source, size, rate)``: mean repetitions that give each source its share.

    ``size`` counts characters, at least one per document. ``weights`` holds
    ``(source, weight)``; a source it lacks or gives a null or negative weight
    gets rate 0, repeated sources add up. Without it the weight is size to the
    power ``temperature``. The mix keeps the total size. Null is a source.
    """
    sizes = docs.groupBy("source").agg(
        F.sum(F.greatest(F.lit(1), F.coalesce(F.length("text"), F.lit(0)))).alias("size")
    )
    if weights is None:
        weighted = sizes.withColumn("weight", F.pow(F.col("size"), F.lit(temperature)))
    else:
        given = weights.groupBy(F.col("source").alias("named")).agg(
            F.sum(F.greatest(F.lit(0.0), F.col("weight").cast("double"))).alias("weight")
        )
        weighted = sizes.join(given, F.col("source").eqNullSafe(F.col("named")), "left").select(
            "source", "size", F.coalesce("weight", F.lit(0.0)).alias("weight")
        )
    # One row per source; the totals are one row, known to be small.
    weighted = stored(weighted, "source_weights")
    totals = weighted.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"))
    return weighted.crossJoin(F.broadcast(totals)).select(
        "source",
        "size",
        F.coalesce(
            F.col("all_size") * F.col("weight") / F.nullif(F.col("all_weight"), F.lit(0.0)) / F.col("size"),
            F.lit(0.0),
        ).alias("rate"),
    )


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    temperature: float = TEMPERATURE,
    seed: int = SEED,
) -> DataFrame:
    """Rows of ``docs`` repeated and shuffled; adds ``copy`` and ``shuffle_key``.

    Returns doc_id, text, lang, source and n_chars of each copy, its number
    from 1, and the key that the whole result is sorted by. Rows that repeat a
    doc_id get equal counts and keys, as does every null doc_id. Null texts are
    passed through. Extra columns are ignored; an empty table gives no rows.
    """
    base = docs.select("doc_id", "text", "lang", "source", "n_chars")
    rates = source_rates(base, weights, temperature).select(
        F.col("source").alias("rated"), poisson_distribution(F.col("rate")).alias("below")
    )
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    draw = uniform(F.lit(str(seed)), F.lit("count"), name)
    count = F.size(F.filter("below", lambda p: p < F.col("draw")))
    copies = (
        base.withColumn("draw", draw)
        .join(rates, F.col("source").eqNullSafe(F.col("rated")))
        .withColumn("count", F.when(F.col("below").isNull(), 0).otherwise(count))
        .where("count > 0")
        .select(*base.columns, F.explode(F.sequence(F.lit(1), F.col("count"))).alias("copy"))
    )
    key = F.md5(
        F.concat_ws("/", F.lit(str(seed)), F.lit("order"), name, F.col("copy").cast("string")).cast("binary")
    )
    return copies.withColumn("shuffle_key", key).orderBy("shuffle_key")

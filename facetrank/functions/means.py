"""Weighted means whose value does not depend on the order of the rows.

Ranks and argmax compare means for equality, so two groups made of the same
titles must get the same double whatever the partitioning. A plain sum of
doubles does not promise that. Here every number counts as the decimal that
Spark writes for it (0.1 is one tenth), and sums are exact:

- A row whose value is a whole number of millionths and whose weight is a whole
  number gives one product and one weight, both whole.
- Any other row is cut into digits: the nine-digit halves of both mantissas are
  multiplied pair by pair, and each product goes to the *bin* of its power of
  ten. Bins are nine powers apart, so a bin's sum is a whole decimal as well.

Sums are taken per group and bin, then a group's few bins are put together and
rounded to a double once. Doubles of any size, in values and in weights, give
the mean of their exact sums; NaN and infinities are errors, and so is a bin
whose sum passes 38 digits. Nothing wraps.

With ``scale`` the caller declares that values have at most so many decimals and
that weights are whole. Then there is one bin and one aggregation less, and a
value that has more decimals is an error.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegralType

PRODUCT, WEIGHT, BIN = "_product", "_weight", "_bin"
# Decimals of the values in bin 0; products of other bins are this far apart as well.
SCALE = 6
_STEP = 9
_HALF = 10**_STEP
_SUM = "decimal(38,0)"
_PARTS = f"array<struct<{BIN}:int,{PRODUCT}:{_SUM},{WEIGHT}:{_SUM}>>"


def _number(df: DataFrame, name: str) -> Column:
    """A column as a bigint or floating number; others are read as doubles."""
    kind = df.schema[name].dataType
    if isinstance(kind, IntegralType):
        return F.col(name).cast("bigint")
    if isinstance(kind, (DoubleType, FloatType)):
        return F.col(name)
    return F.col(name).cast("double")


def _whole(x: Column, unit: int, limit: float) -> tuple[Column, Column]:
    """``x`` in units of 1/``unit`` as a bigint, and whether that is exact."""
    scaled = F.rint(x.cast("double") * F.lit(float(unit)))
    exact = (scaled / F.lit(float(unit)) == x) & (F.abs(scaled) < F.lit(limit))
    return scaled, exact


def _digits(x: Column) -> tuple[Column, Column]:
    """Signed mantissa and power of ten of the decimal that Spark writes for ``x``."""
    text = x.cast("string")
    head = F.substring_index(text, "E", 1)
    power = F.when(F.contains(text, F.lit("E")), F.substring_index(text, "E", -1).cast("int"))
    decimals = F.when(F.contains(head, F.lit(".")), F.length(F.substring_index(head, ".", -1)))
    return (
        F.translate(head, ".", "").cast("bigint"),
        F.coalesce(power, F.lit(0)) - F.coalesce(decimals, F.lit(0)),
    )


def _let(held: Column, use: Callable[[Column], Column]) -> Column:
    """``use(held)`` with ``held`` worked out once; the plan holds it once as well."""
    return F.get(F.transform(F.array(held), use), F.lit(0))


def _halves(mantissa: Column) -> Column:
    """Nine-digit halves, low first, with the sign of the whole."""
    low = mantissa % F.lit(_HALF)
    return F.array(low, F.try_divide(mantissa - low, F.lit(_HALF))).cast("array<decimal(11,0)>")


def _part(number: Column, power: Column, base: int, product: bool) -> Column:
    """``number * 10**power`` as a part of the bin it falls into."""

    def placed(place: Column) -> Column:
        up = F.pow(F.lit(10.0), F.pmod(place, F.lit(_STEP))).cast("decimal(10,0)")
        held = (number * up).cast(_SUM)
        none = F.lit(None).cast(_SUM)
        bin_ = F.floor(place / F.lit(float(_STEP)))
        return _struct(bin_, *((held, none) if product else (none, held)))

    return _let(power + F.lit(base), placed)


def _struct(bin_: Column, product: Column, weight: Column) -> Column:
    return F.struct(
        bin_.cast("int").alias(BIN), product.cast(_SUM).alias(PRODUCT), weight.cast(_SUM).alias(WEIGHT)
    )


def _cut(v: Column, w: Column) -> Column:
    """The parts of one row, by digits."""
    def parts(x: Column) -> Column:
        def own(half: Column, i: Column) -> Column:
            return _part(half, x["w_power"] + F.lit(_STEP) * i, 0, False)

        def crossed(a: Column, i: Column) -> Column:
            return F.transform(
                x["w_halves"],
                lambda b, j: _part(a * b, x["v_power"] + x["w_power"] + F.lit(_STEP) * (i + j), SCALE, True),
            )

        weights = F.transform(x["w_halves"], own)
        products = F.flatten(F.transform(x["v_halves"], crossed))
        return F.when(x["v_power"].isNull(), weights).otherwise(F.concat(products, weights))

    fields = []
    for number, name in ((v, "v"), (w, "w")):
        mantissa, power = _digits(number)
        # The power of a missing number is missing as well.
        power = F.when(number.isNotNull(), power)
        fields += [_halves(mantissa).alias(f"{name}_halves"), power.alias(f"{name}_power")]
    endless = F.lit(False)
    for number in (v, w):
        as_double = number.cast("double")
        endless = endless | F.isnan(as_double) | (F.abs(as_double) == F.lit(float("inf")))
    refused = F.raise_error(
        F.concat_ws(" ", F.lit("not a finite number:"), v.cast("string"), w.cast("string"))
    )
    return (
        F.when(F.coalesce(endless, F.lit(False)), refused.cast(_PARTS))
        .when(w.isNull(), F.array(_struct(F.lit(0), F.lit(None), F.lit(None))))
        .otherwise(_let(F.struct(*fields), parts))
    )


def weigh(df: DataFrame, value: str, weight: str, scale: int | None = None) -> DataFrame:
    """Replace ``value`` and ``weight`` by summable parts; a row may become several.

    A NULL value adds nothing to the products, but its weight counts; a NULL
    weight adds nothing at all.
    """
    v, w = _number(df, value), _number(df, weight)
    kept = [c for c in df.columns if c not in (value, weight)]
    if scale is not None:
        return _weigh_declared(df, v, w, kept, scale)
    whole, exact = _whole(v, 10**SCALE, 1e15)
    units, countable = _whole(w, 1, 1e12)
    simple = _struct(
        F.lit(0),
        whole.try_cast("bigint").try_cast("decimal(16,0)") * units.try_cast("bigint").try_cast("decimal(13,0)"),
        units.try_cast("bigint"),
    )
    fits = (v.isNull() | exact) & (w.isNull() | countable)
    # A lambda is not compiled into the stage, so rows that fit pay nothing for it.
    numbers = F.array(F.struct(v.alias("v"), w.alias("w")))
    cut = F.flatten(F.transform(numbers, lambda pair: _cut(pair["v"], pair["w"])))
    parts = F.when(fits, F.array(simple)).otherwise(cut)
    return df.select(*kept, F.inline(parts))


def _weigh_declared(df: DataFrame, v: Column, w: Column, kept: list[str], scale: int) -> DataFrame:
    whole, exact = _whole(v, 10**scale, 1e15)
    units, countable = _whole(w, 1, 1e15)
    fits = F.coalesce(exact, F.lit(True)) & F.coalesce(countable, F.lit(True))
    refused = F.raise_error(
        F.concat(
            F.lit("value or weight does not fit the declared decimals: "),
            F.concat_ws(", ", v.cast("string"), w.cast("string")),
        )
    )
    whole = F.when(fits, whole.try_cast("bigint")).otherwise(refused.cast("bigint"))
    units = units.try_cast("bigint")
    return df.select(
        *kept,
        (whole.cast("decimal(16,0)") * units.try_cast("decimal(16,0)")).cast(_SUM).alias(PRODUCT),
        units.cast(_SUM).alias(WEIGHT),
    )


def _rounded(bins: Column, sums: str, base: int) -> Column:
    """The sum over the bins of a group, rounded to a double once.

    Bins are added from the lowest up and carried, nine digits each; more bins
    than a sum has digits take the last carry. A negative total leaves a carry of
    -1, then the bins are summed with their signs turned. Digits and power are
    read as one number, which rounds correctly.
    """
    step = F.lit(_HALF).cast("decimal(10,0)")
    zero = F.lit(0).cast(_SUM)

    def carried(x: Column, sign: Column) -> Column:
        def add(state: Column, bin_: Column) -> Column:
            own = F.coalesce(F.try_element_at(x["held"], bin_), zero) * sign
            return _let(
                (own + state["carry"]).cast(_SUM),
                lambda total: F.struct(
                    ((total - F.pmod(total, step)) / step).cast(_SUM).alias("carry"),
                    F.concat(
                        F.lpad(F.pmod(total, step).cast("bigint").cast("string"), _STEP, "0"), state["text"]
                    ).alias("text"),
                ),
            )

        return F.aggregate(
            F.sequence(x["lowest"], x["highest"] + F.lit(5)),
            F.struct(zero.alias("carry"), F.lit("").alias("text")),
            add,
        )

    def number(x: Column) -> Column:
        power = F.concat(F.lit("E"), (x["lowest"] * F.lit(_STEP) - F.lit(base)).cast("string"))
        signs = F.array(F.lit(1).cast("decimal(1,0)"), F.lit(-1).cast("decimal(1,0)"))
        return _let(
            F.transform(signs, lambda sign: carried(x, sign)),
            lambda both: F.when(both[0]["carry"] >= 0, F.concat(both[0]["text"], power))
            .otherwise(F.concat(F.lit("-"), both[1]["text"], power))
            .cast("double"),
        )

    # Only bins that hold something; none gives NULL.
    summed = F.filter(bins, lambda b: b[sums].isNotNull())
    many = F.struct(
        F.map_from_entries(F.transform(summed, lambda b: F.struct(b[BIN], b[sums]))).alias("held"),
        F.array_min(F.transform(summed, lambda b: b[BIN])).alias("lowest"),
        F.array_max(F.transform(summed, lambda b: b[BIN])).alias("highest"),
    )
    return F.when(F.size(summed) > 0, _let(many, number))


def group_sums(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group the sums of value * weight and of the weights, as doubles.

    ``parts`` comes from :func:`weigh`. Sums combine map-side; then a group moves
    as one row per bin, which is one row unless numbers were cut into digits.
    """
    sums = [F.sum(PRODUCT).alias(PRODUCT), F.sum(WEIGHT).alias(WEIGHT)]
    if BIN not in parts.columns:
        raise ValueError("parts of declared decimals are summed by declared_sums")
    found = parts.groupBy(*by, BIN).agg(*sums)
    bins = F.collect_list(F.struct(BIN, PRODUCT, WEIGHT)).alias("_bins")
    found = found.groupBy(*by).agg(bins)
    alone = (F.size("_bins") == 1) & (F.col("_bins")[0][BIN] == 0)

    def total(sums: str, base: int) -> Column:
        only = F.concat(F.col("_bins")[0][sums].cast("string"), F.lit(f"E-{base}")).cast("double")
        return F.when(alone, only).otherwise(_rounded(F.col("_bins"), sums, base)).alias(sums)

    return found.select(*by, total(PRODUCT, SCALE), total(WEIGHT, 0))


def declared_sums(parts: DataFrame, by: Sequence[str], scale: int) -> DataFrame:
    """As :func:`group_sums`, in one aggregation, for parts made with ``scale``."""
    power = F.lit(f"E-{scale}")
    return (
        parts.groupBy(*by)
        .agg(F.sum(PRODUCT).alias(PRODUCT), F.sum(WEIGHT).alias(WEIGHT))
        .select(
            *by,
            F.concat(F.col(PRODUCT).cast("string"), power).cast("double").alias(PRODUCT),
            F.col(WEIGHT).cast("double").alias(WEIGHT),
        )
    )


def sums_of(parts: DataFrame, by: Sequence[str], scale: int | None = None) -> DataFrame:
    return group_sums(parts, by) if scale is None else declared_sums(parts, by, scale)


def mean_from_sums(digits: int | None = None) -> Column:
    """Mean from summed parts; NULL when the weights add up to zero."""
    mean = F.try_divide(F.col(PRODUCT), F.col(WEIGHT))
    return mean if digits is None else F.round(mean, digits)


def weighted_mean(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    weight: str,
    name: str,
    digits: int | None = None,
    scale: int | None = None,
    explode: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per group with sum(value * weight) / sum(weight).

    ``digits`` rounds half up. Partial sums are taken before the shuffle, so a
    group holding most of the rows sends one row per task and bin. ``explode``
    makes the columns ``by`` out of other columns of ``df``, a row becoming
    several; it is given rows that are weighed, so that each is weighed once.
    """
    rows = df.select(*by, value, weight) if explode is None else df
    parts = weigh(rows, value, weight, scale)
    if explode is not None:
        parts = explode(parts)
    return sums_of(parts, by, scale).select(*by, mean_from_sums(digits).alias(name))

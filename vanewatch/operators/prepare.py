"""From raw rows to the scaled, labelled table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewatch.functions.scalars import clip_upper, minmax
from vanewatch.operators.ordering import running, with_ordinal, Before
from vanewatch.session import materialized
from vanewatch.spec import (
    CLIP,
    DROP_COLUMNS,
    RAW_COLUMNS,
    ROWS_PER_SLICE,
    SPLIT_SEED,
    TEST_SHARE,
)


# --- columns ---------------------------------------------------------------------------------


def rename_positional(df: DataFrame, names: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    return df.toDF(*names)


def drop_unused(df: DataFrame, columns: Sequence[str] = DROP_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def feature_columns(df: DataFrame, prefix: str = "s") -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def _long(wide: DataFrame, names: Sequence[str], fields: Sequence[str], key: str) -> DataFrame:
    """One-row frame with columns ``field__name`` to one row per name."""
    entry = [
        F.struct(F.lit(n).alias(key), *[F.col(f"{f}__{n}").alias(f) for f in fields]) for n in names
    ]
    return wide.select(F.inline(F.array(*entry)))


def column_spread(df: DataFrame, columns: Sequence[str], threshold: float = 0.01) -> DataFrame:
    """Sample standard deviation per column, and whether it is low enough to drop the column."""
    wide = df.agg(*[F.stddev_samp(c).alias(f"std__{c}") for c in columns])
    return _long(wide, columns, ["std"], "sensor").withColumn("drop", F.col("std") < threshold)


# --- scaling ---------------------------------------------------------------------------------


def minmax_fit(train: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """(sensor, mn, mx) from one pass over the training rows."""
    aggs = [f(s).cast("double").alias(f"{n}__{s}") for s in sensors for n, f in (("mn", F.min), ("mx", F.max))]
    return _long(train.agg(*aggs), sensors, ["mn", "mx"], "sensor")


def minmax_apply(
    df: DataFrame, params: DataFrame, sensors: Sequence[str], clamped: bool = False
) -> DataFrame:
    """Scale sensors by the limits in ``params``, read once as a scalar subquery."""
    def of(s: str, field: str) -> Column:
        return F.max(F.when(F.col("sensor") == s, F.col(field))).alias(f"{field}__{s}")

    limits = params.agg(F.struct(*[of(s, f) for s in sensors for f in ("mn", "mx")])).scalar()
    low, high = "_limits.mn__{}".format, "_limits.mx__{}".format
    scaled = {s: minmax(F.col(s).cast("double"), F.col(low(s)), F.col(high(s)), clamped) for s in sensors}
    return df.withColumn("_limits", limits).withColumns(scaled).drop("_limits")


def minmax_apply_constants(
    df: DataFrame, limits: Mapping[str, tuple[float, float]], clamped: bool = True
) -> DataFrame:
    """Scale by constants in float32, as a stream job does; values end up in [0, 1]."""

    def scaled(s: str, lo: float, hi: float) -> Column:
        x, a, b = (c.cast("float") for c in (F.col(s), F.lit(lo), F.lit(hi)))
        return minmax(x, a, b, clamped).cast("float")

    return df.withColumns({s: scaled(s, lo, hi) for s, (lo, hi) in limits.items()})


# --- labels ----------------------------------------------------------------------------------


def lifetimes(df: DataFrame, entity: str = "unit", ordinal: str = "cycle") -> DataFrame:
    return df.groupBy(entity).agg(F.max(ordinal).alias("max_cycle"))


def add_rul(
    df: DataFrame,
    entity: str = "unit",
    ordinal: str = "cycle",
    clip: float = CLIP,
    out: str = "RUL",
) -> DataFrame:
    """Cycles left until the last one of the unit, at most ``clip``.

    A partial aggregate and a join instead of a window, so that no unit has to fit into one task.
    The lifetimes are written first: with their true size known, Spark broadcasts them and leaves
    the rows where they are, or, with too many units for that, shuffles and splits hot units.
    """
    ends = materialized(lifetimes(df, entity, ordinal), "lifetimes")
    left = F.col("max_cycle") - F.col(ordinal)
    return df.join(ends, entity).withColumn(out, clip_upper(left, clip))


def attach_positional(
    values: DataFrame,
    units: DataFrame,
    position: str = "pos",
    entity: str = "unit",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """The i-th value (positions from 1) belongs to the i-th unit in ascending order.

    Raises while running when the counts differ.
    """
    known = materialized(units.select(entity).distinct(), "units")
    ranked = with_ordinal(known, [], [entity], position, rows_per_slice)
    listed = values.withColumn("_listed", F.lit(True))
    both = ranked.join(listed, position, "full")
    mismatch = F.col(entity).isNull() | F.col("_listed").isNull()
    kind = units.schema[entity].dataType
    checked = F.when(
        mismatch, F.raise_error(F.lit("the number of values differs from the number of units")).cast(kind)
    ).otherwise(F.col(entity))
    return both.withColumn(entity, checked).drop("_listed")


def join_final_rul(df: DataFrame, final: DataFrame, entity: str = "unit") -> DataFrame:
    """Every row of a unit gets the unit's final, unclipped value; ``final`` has a row per unit."""
    return df.join(materialized(final, "final"), entity, "left")


def last_values(df: DataFrame, entity: str, ordinal: str, columns: Sequence[str]) -> DataFrame:
    """Per unit and column, the last value that is not NULL."""
    return df.groupBy(entity).agg(
        F.max(ordinal).alias(ordinal),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ordinal))).alias(c) for c in columns],
    )


# --- descriptions ----------------------------------------------------------------------------


def lifespan_stats(df: DataFrame, entity: str = "unit", ordinal: str = "cycle") -> DataFrame:
    return lifetimes(df, entity, ordinal).agg(
        F.count(F.lit(1)).alias("units"),
        F.min("max_cycle").alias("min_life"),
        F.max("max_cycle").alias("max_life"),
        F.avg("max_cycle").alias("mean_life"),
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; empty bins count zero.

    A single distinct value gets a range of one around it.
    """
    x = F.col(column).cast("double")
    span = df.agg(F.min(x).alias("a"), F.max(x).alias("b")).select(
        F.when(F.col("a") == F.col("b"), F.col("a") - 0.5).otherwise(F.col("a")).alias("lo"),
        F.when(F.col("a") == F.col("b"), F.col("b") + 0.5).otherwise(F.col("b")).alias("hi"),
    )
    lo, hi = F.col("_span.lo"), F.col("_span.hi")
    place = F.least(F.floor((x - lo) * bins / (hi - lo)), F.lit(bins - 1))
    ranged = df.where(x.isNotNull()).withColumn("_span", span.select(F.struct("lo", "hi")).scalar())
    counts = ranged.groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (F.col("hi") - F.col("lo")) / bins
    spine = span.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return spine.join(counts, "bin", "left").select(
        F.col("bin").cast("bigint").alias("bin"),
        (F.col("lo") + F.col("bin") * width).alias("bin_start"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


# --- split -----------------------------------------------------------------------------------


def split_units(
    df: DataFrame,
    entity: str = "unit",
    share: float = TEST_SHARE,
    seed: int = SPLIT_SEED,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """(unit, is_validation): the ``ceil(share * n)`` units with the smallest hash."""
    digest = F.md5(F.concat_ws(":", F.col(entity).cast("string"), F.lit(str(seed))))
    units = (
        materialized(df.select(entity).distinct(), "units")
        .withColumn("_digest", digest)
        # leading hex digits as a number: same order as the digest, and evenly spread
        .withColumn("_lead", F.conv(F.substring("_digest", 1, 12), 16, 10).cast("bigint"))
    )
    ranked = running(units, [], ["_lead", "_digest", entity], {"_rank": Before("count")}, rows_per_slice)
    n = units.agg(F.ceil(F.count(F.lit(1)) * F.lit(share))).scalar()
    return ranked.select(entity, (F.col("_rank") < n).alias("is_validation"))


def train_validation(df: DataFrame, entity: str = "unit", **settings) -> tuple[DataFrame, DataFrame]:
    """Rows of the training and of the validation units; no unit is in both."""
    chosen = split_units(df, entity, **settings).where("is_validation").select(entity)
    validation = materialized(chosen, "validation-units")
    return df.join(validation, entity, "left_anti"), df.join(validation, entity, "left_semi")

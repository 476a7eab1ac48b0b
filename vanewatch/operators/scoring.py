"""From feature windows to prediction records."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewatch.functions import scalars
from vanewatch.functions.vectors import array_mean, array_stddev_pop, dot, sensor_value
from vanewatch.operators.quality import missing_keys, window_fits
from vanewatch.spec import CLIP, MISSING_KEYS, WINDOW, WRONG_COUNT, WRONG_SHAPE


def linear_score(features: Column | str, weights: Sequence[float] | Column, bias: float = 0.0) -> Column:
    """Normalised remaining life of a flat feature array under a linear model."""
    if not isinstance(weights, Column):
        weights = F.array(*[F.lit(float(w)) for w in weights])
    return dot(features, weights) + F.lit(float(bias))


def batch_score(windows: Column | str, weights: Sequence[float], bias: float = 0.0) -> Column:
    """The same score for nested windows, one matrix product per Arrow batch.

    A window that does not hold as many values as there are weights scores NULL; a missing value gives
    NaN. Lengths come from the list offsets, no window is turned into Python objects.
    """
    vector = np.asarray(weights, dtype=np.float64)

    @F.arrow_udf("double")
    def score(batch: pa.Array) -> pa.Array:
        outer, inner = batch.offsets.to_numpy(), batch.values.offsets.to_numpy()
        fits = (inner[outer[1:]] - inner[outer[:-1]]) == len(vector)
        fits &= batch.is_valid().to_numpy(zero_copy_only=False)
        chosen = batch if fits.all() else batch.filter(pa.array(fits))
        flat = chosen.flatten().flatten().to_numpy(zero_copy_only=False)
        result = np.full(len(batch), np.nan)
        result[fits] = flat.astype(np.float64).reshape(-1, len(vector)) @ vector + bias
        return pa.array(result, mask=~fits)

    return score(windows)


def prediction_records(
    df: DataFrame,
    y: str,
    timestamp: Column,
    version: str,
    confidence: Column | None = None,
    clip: float = CLIP,
    band_on_rounded: bool = False,
    key: str = "engine_id",
) -> DataFrame:
    """Add the prediction fields to rows with a normalised remaining life ``y``.

    The band follows the unrounded risk unless ``band_on_rounded``.
    """
    # The score may be costly. As generator output it is computed once per row, and a later filter
    # on the band is not pushed below it with copies of the whole expression.
    df = df.select("*", F.inline(F.array(F.struct(F.col(y).cast("double").alias("_score")))))
    # a NaN score counts as no life left; NULL stays NULL
    value = F.col("_score")
    floor = F.when(F.isnan(value), F.lit(0.0)).otherwise(F.greatest(value * F.lit(float(clip)), F.lit(0.0)))
    rul = F.when(value.isNotNull(), floor)
    risk = scalars.risk(rul, clip)
    shown = F.bround(risk, 3)
    return df.select(
        key,
        F.bround(rul, 0).cast("int").alias("remaining_cycles"),
        shown.alias("failure_risk"),
        scalars.risk_band(shown if band_on_rounded else risk).alias("risk_level"),
        (F.lit(1.0) if confidence is None else confidence).alias("confidence"),
        timestamp.alias("timestamp"),
        F.lit(version).alias("model_version"),
    )


def ensemble_summary(df: DataFrame, members: str, mean: str = "y", std: str = "y_std") -> DataFrame:
    """Mean, population deviation and confidence of an array of member scores."""
    return df.withColumns({mean: array_mean(F.col(members)), std: array_stddev_pop(F.col(members))}).withColumn(
        "confidence", scalars.confidence(std)
    )


def ensemble_summary_rows(
    df: DataFrame, keys: Sequence[str], score: str, mean: str = "y", std: str = "y_std"
) -> DataFrame:
    """The same from one row per member."""
    return (
        df.groupBy(*keys)
        .agg(F.avg(score).alias(mean), F.stddev_pop(score).alias(std))
        .withColumn("confidence", scalars.confidence(std))
    )


def window_error(windows: str, window: int, width: int) -> Column:
    """Message for a window of the wrong shape, else NULL."""
    found = F.concat(
        F.lit("("), F.size(windows), F.lit(", "), F.coalesce(F.size(F.get(windows, F.lit(0))), F.lit(0)), F.lit(")")
    )
    message = F.concat(F.lit(WRONG_SHAPE.format(window=window, width=width)), found)
    return F.when(~F.coalesce(window_fits(windows, window, width), F.lit(False)), message)


def score_or_error(
    requests: DataFrame,
    weights: Sequence[float] | Column,
    timestamp: Column,
    version: str,
    width: int,
    bias: float = 0.0,
    window: int = WINDOW,
    clip: float = CLIP,
    windows: str = "sensor_data",
    key: str = "engine_id",
) -> DataFrame:
    """Score each request in one pass; a bad one gets ``error`` and no prediction."""
    checked = requests.withColumn("error", window_error(windows, window, width))
    y = F.when(F.col("error").isNull(), linear_score(F.flatten(windows), weights, bias))
    scored = checked.withColumn("_y", y)
    records = prediction_records(scored.withColumn(key, F.struct(key, "error")), "_y", timestamp, version, clip=clip)
    bad = F.col(f"{key}.error").isNotNull()
    fields = [c for c in records.columns if c != key]
    return records.select(
        F.col(f"{key}.{key}").alias(key),
        *[F.when(~bad, F.col(c)).alias(c) for c in fields],
        F.col(f"{key}.error").alias("error"),
    )


def raw_windows(
    readings: DataFrame,
    limits: dict[str, tuple[float, float]],
    window: int = WINDOW,
    column: str = "readings",
    reject_missing: bool = True,
) -> DataFrame:
    """Arrays of raw sensor maps to scaled windows (not clamped), with an error where they do not fit.

    ``reject_missing`` reports absent sensors; otherwise they count as zero.
    """
    sensors = list(limits)

    def scaled(reading: Column) -> Column:
        return F.array(
            *[
                scalars.minmax(
                    sensor_value(reading, s).cast("double"), F.lit(float(lo)), F.lit(float(hi))
                ).cast("float")
                for s, (lo, hi) in limits.items()
            ]
        )

    absent = F.array_distinct(F.flatten(F.transform(column, lambda r: missing_keys(r, sensors))))
    wrong_count = F.size(column) != window
    error = F.when(
        wrong_count, F.concat(F.lit(WRONG_COUNT.format(window=window)), F.size(column))
    )
    if reject_missing:
        names = F.array_join(absent, ", ")
        error = error.when(F.size(absent) > 0, F.concat(F.lit(MISSING_KEYS), names))
    return readings.withColumn("error", error).withColumn(
        "sensor_data", F.when(F.col("error").isNull(), F.transform(column, scaled))
    )

"""Array expressions over sensor rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vanewatch.functions.scalars import minmax


def sensor_row(sensors: Sequence[str]) -> Column:
    """One reading as ARRAY<FLOAT>; NULL sensors stay in place."""
    return F.array(*[F.col(s).cast("float") for s in sensors])


def sensor_value(mapping: Column | str, sensor: str, absent: float = 0.0) -> Column:
    """Reading as FLOAT: an absent key gives ``absent``, a JSON null gives NaN."""
    mapping = F.col(mapping) if isinstance(mapping, str) else mapping
    found = F.coalesce(mapping[sensor], F.lit(float("nan")))
    return F.when(F.map_contains_key(mapping, sensor), found).otherwise(F.lit(absent)).cast("float")


def sensor_row_from_map(mapping: Column | str, sensors: Sequence[str], absent: float = 0.0) -> Column:
    """Fixed-order vector from a sensor map."""
    return F.array(*[sensor_value(mapping, s, absent) for s in sensors])


def pad_front(rows: Column, window: int, width: int) -> Column:
    """Array of rows, filled at the front with zero rows up to ``window``."""
    zero = F.array_repeat(F.lit(0.0).cast("float"), width)
    return F.concat(F.array_repeat(zero, F.lit(window) - F.size(rows)), rows)


def dot(features: Column | str, weights: Column) -> Column:
    """Sum of products of two arrays of equal length."""
    features = F.col(features) if isinstance(features, str) else features
    products = F.zip_with(features, weights, lambda x, w: x.cast("double") * w)
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def array_mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v) / F.size(values)


def array_stddev_pop(values: Column) -> Column:
    mean = array_mean(values)
    return F.sqrt(array_mean(F.transform(values, lambda v: (v - mean) * (v - mean))))


def normalized_vector(mapping: Column | str, limits: dict[str, tuple[float, float]]) -> Column:
    """Sensor map to a float32 vector scaled into [0, 1]; absent sensors count as raw zero."""

    raw = sensor_row_from_map(mapping, list(limits))
    bounds = F.array(
        *[
            F.struct(F.lit(float(lo)).cast("float").alias("lo"), F.lit(float(hi)).cast("float").alias("hi"))
            for lo, hi in limits.values()
        ]
    )
    # a lambda binds each reading once, where plain expressions would repeat its lookup
    return F.zip_with(raw, bounds, lambda x, b: minmax(x, b["lo"], b["hi"], clamped=True).cast("float"))

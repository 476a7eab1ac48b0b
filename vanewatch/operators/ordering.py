"""Ordered work inside a key without putting a whole key into one task.

A plain ``Window.partitionBy(key)`` sends all rows of a key to one task. One machine may hold a
third of all rows, so keys with more than ``rows_per_slice`` rows are cut along their order:

1. one aggregate counts the rows of each key. Without a large key, that is all: plain windows follow;
2. rows of large keys are range-partitioned by key and the whole order, so that slices hold about
   equally many rows whatever the values are: outliers, NaN, infinities and ties in the first order
   column do not put rows together. The cut rows are written once. A row's slice is its range
   partition; any other row gets slice 0. Windows then run over (key, slice);
3. one summary row per slice of a large key is accumulated over the earlier slices and carried back
   to the rows of each slice. There are about ``2 * rows / rows_per_slice`` of these; they are
   written too, so that Spark chooses the join by their size.

Results equal those of the plain window for any slice size. Steps 1 and 2 read the key and order
columns again, so the input should be a stored table; write the result of an expensive plan first
(``session.materialized``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vanewatch.session import materialized
from vanewatch.spec import ROWS_PER_SLICE

SLICE = "_slice"
_HOT = "_hot"
_ALL = "_all"


@dataclass(frozen=True)
class Before:
    """A value taken over the rows strictly before the current one: sum, max, count or lag."""

    kind: str
    column: str | Column | None = None


def slice_large_keys(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Add ``_slice`` (BIGINT, ascending with the order inside a key) and ``_hot`` (is this a cut key)."""
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_slice)
    large = materialized(large, "large-keys")
    total = large.agg(F.sum("_n")).first()[0]
    if not total:
        return df.withColumns({_HOT: F.lit(False), SLICE: F.lit(0).cast("bigint")})
    same = [df[k].eqNullSafe(large[k]) for k in keys]
    parts = -(-2 * total // rows_per_slice)
    cut = df.join(large, same, "left_semi").repartitionByRange(parts, *keys, *order)
    cut = cut.withColumns({_HOT: F.lit(True), SLICE: F.spark_partition_id().cast("bigint")})
    rest = df.join(large, same, "left_anti").withColumns({_HOT: F.lit(False), SLICE: F.lit(0).cast("bigint")})
    return materialized(cut, "slices").unionByName(rest)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    outputs: Mapping[str, Before],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add columns computed over all earlier rows of the key; one shuffle for all of them.

    ``order`` must be a total order inside a key.
    """
    keys = list(keys)
    if not keys:
        whole = running(df.withColumn(_ALL, F.lit(1)), [_ALL], order, outputs, rows_per_slice)
        return whole.drop(_ALL)

    sliced = slice_large_keys(df, keys, order, rows_per_slice)
    rows = Window.partitionBy(*keys, SLICE).orderBy(*order)
    earlier = rows.rowsBetween(Window.unboundedPreceding, -1)
    slices = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)

    # A lagged value travels inside a struct, so that a NULL value differs from "no earlier row".
    # Sums keep the type of their column: local and carried parts add up in that type.
    summaries, carried, local, combined = [], [], {}, {}
    for i, (name, spec) in enumerate(outputs.items()):
        tmp, carry = f"_part{i}", f"_carry{i}"
        value = F.col(spec.column) if isinstance(spec.column, str) else spec.column
        if spec.kind == "count":
            summaries.append(F.count(F.lit(1)).alias(tmp))
            carried.append(F.sum(tmp).over(slices).alias(carry))
            local[name] = F.row_number().over(rows).cast("bigint") - 1
            combined[name] = F.col(name) + F.coalesce(F.col(carry), F.lit(0))
        elif spec.kind == "sum":
            summaries.append(F.sum(value).alias(tmp))
            carried.append(F.sum(tmp).over(slices).alias(carry))
            local[name] = F.sum(value).over(earlier)
            combined[name] = F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col(carry), F.lit(0))
        elif spec.kind == "max":
            summaries.append(F.max(value).alias(tmp))
            carried.append(F.max(tmp).over(slices).alias(carry))
            local[name] = F.max(value).over(earlier)
            combined[name] = F.greatest(F.col(name), F.col(carry))
        elif spec.kind == "lag":
            boxed = F.struct(value.alias("v"))
            summaries.append(F.max_by(boxed, F.struct(*order)).alias(tmp))
            carried.append(F.last(tmp, ignorenulls=True).over(slices).alias(carry))
            local[name] = F.lag(boxed).over(rows)
            combined[name] = F.coalesce(F.col(name), F.col(carry))["v"]
        else:
            raise ValueError(f"unknown kind {spec.kind}")

    carry_in = materialized(
        sliced.where(F.col(_HOT)).groupBy(*keys, SLICE).agg(*summaries).select(*keys, SLICE, *carried), "carried"
    )
    placed = sliced.withColumns(local)
    same = [placed[k].eqNullSafe(carry_in[k]) for k in (*keys, SLICE)]
    joined = placed.join(carry_in, same, "left").drop(*[carry_in[k] for k in (*keys, SLICE)])
    return joined.withColumns(combined).select(*df.columns, *outputs)


def with_ordinal(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Number the rows of each key 1, 2, 3, ... in the given order."""
    counted = running(df, keys, order, {out: Before("count")}, rows_per_slice)
    return counted.withColumn(out, F.col(out) + 1)


def last_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, out: str = "_back"
) -> DataFrame:
    """The last ``n`` rows of each key; ``out`` counts back from 1 at the newest.

    Spark limits each group before the shuffle, so a task sends at most ``n`` rows per key.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn(out, F.row_number().over(newest)).where(F.col(out) <= n)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """The newest row of each key as a partial aggregate: no sort, no hot task."""
    columns = [c for c in (columns or df.columns) if c not in keys]
    newest = F.max_by(F.struct(*columns), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col("_row")[c].alias(c) for c in columns])

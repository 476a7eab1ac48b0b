"""Feature windows: sliding, last-and-padded, in arrival order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vanewatch.functions.vectors import pad_front
from vanewatch.operators.ordering import Before, last_per_key, running, with_ordinal
from vanewatch.session import materialized
from vanewatch.spec import ROWS_PER_CHUNK, ROWS_PER_SLICE, WINDOW


def sliding_frames(
    df: DataFrame,
    entity: str,
    order: Sequence[str],
    row: str,
    window: int = WINDOW,
    out: str = "features",
    contiguous: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """For each row with ``window - 1`` rows before it: the array of those rows and itself.

    ``row`` is the column that goes into the array. Rows are numbered per entity (``contiguous``
    says that the single order column already counts 1, 2, 3, ...), the numbers are cut into
    chunks of a fixed size, and the last ``window - 1`` rows of a chunk are also sent to the
    next. So a task never holds more than one chunk of an entity, however long its history.
    """
    size = max(min(rows_per_chunk, rows_per_slice), window)
    if contiguous:
        numbered = df.withColumn("_seq", F.col(order[0]).cast("bigint"))
    else:
        numbered = with_ordinal(df, [entity], order, "_seq", rows_per_slice)
    place = F.col("_seq") - 1
    home = F.floor(place / size)
    needed_next = place % size >= size - (window - 1)
    copies = (
        numbered.withColumn("_home", home)
        .withColumn(
            "_chunk",
            F.explode(F.when(needed_next, F.array(F.col("_home"), F.col("_home") + 1)).otherwise(F.array("_home"))),
        )
    )
    frame = (
        Window.partitionBy(entity, "_chunk").orderBy("_seq").rowsBetween(-(window - 1), Window.currentRow)
    )
    return (
        copies.withColumn(out, F.collect_list(row).over(frame))
        .where((F.col("_chunk") == F.col("_home")) & (F.col("_seq") >= window) & (F.size(out) == window))
        .select(*df.columns, out)
    )


def last_frames(
    df: DataFrame,
    entity: str,
    order: Sequence[str],
    row: str,
    width: int,
    window: int = WINDOW,
    out: str = "features",
    label: str | None = None,
) -> DataFrame:
    """One window per entity: its last ``window`` rows, zero rows in front if it has fewer."""
    back = last_per_key(df, [entity], order, window)
    rows = F.transform(
        F.sort_array(F.collect_list(F.struct((-F.col("_back")).alias("p"), F.col(row).alias("r")))),
        lambda x: x["r"],
    )
    aggs = [rows.alias("_rows"), *[F.min_by(c, "_back").alias(c) for c in order]]
    if label:
        aggs.append(F.min_by(label, "_back").alias(label))
    return (
        back.groupBy(entity)
        .agg(*aggs)
        .withColumn("n_rows", F.size("_rows").cast("bigint"))
        .withColumn(out, pad_front(F.col("_rows"), window, width))
        .drop("_rows")
    )


def accepted(
    df: DataFrame,
    entity: str,
    arrival: Sequence[str],
    ordinal: str,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Rows whose ordinal is above every earlier one of the entity in arrival order.

    Duplicates and late rows disappear; gaps are fine.
    """
    seen = running(df, [entity], arrival, {"_top": Before("max", ordinal)}, rows_per_slice)
    return seen.where(F.col("_top").isNull() | (F.col(ordinal) > F.col("_top"))).drop("_top")


def arrival_frames(
    df: DataFrame,
    entity: str,
    arrival: Sequence[str],
    ordinal: str,
    row: str,
    window: int = WINDOW,
    out: str = "features",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Batch twin of the rolling stream window: drop late rows, then slide over the rest.

    The accepted rows are written once, because numbering them reads them more than once.
    """
    kept = materialized(accepted(df, entity, arrival, ordinal, rows_per_slice), "accepted")
    return sliding_frames(kept, entity, [ordinal], row, window, out, rows_per_slice=rows_per_slice)


def _by_place(a: Column, b: Column) -> Column:
    return a["p"] - b["p"]


def last_readings(
    log: DataFrame, entity: str, arrival: Sequence[str], columns: Sequence[str], n: int = WINDOW
) -> DataFrame:
    """Last ``n`` readings per entity, oldest first, with their count and readiness."""
    back = last_per_key(log, [entity], arrival, n)
    entry = F.struct((-F.col("_back")).alias("p"), F.struct(*columns).alias("r"))
    return (
        back.groupBy(entity)
        .agg(F.transform(F.array_sort(F.collect_list(entry), _by_place), lambda x: x["r"]).alias("readings"))
        .withColumn("buffered", F.size("readings").cast("bigint"))
        .withColumn("ready", F.col("buffered") >= n)
    )


def buffer_sizes(log: DataFrame, entity: str, n: int = WINDOW) -> DataFrame:
    """How many readings each entity has in its buffer of at most ``n``."""
    held = F.least(F.count(F.lit(1)), F.lit(n)).cast("bigint")
    return log.groupBy(entity).agg(held.alias("buffered")).withColumn("ready", F.col("buffered") >= n)

"""Validation rules over raw lines and over windows and readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vanewatch.spec import RAW_COLUMNS

MAIN_RULES = ("column_count", "numeric", "monotonic_cycle")
RUL_RULES = ("column_count", "numeric", "non_negative")


def file_name(path: Column | str = "file") -> Column:
    return F.element_at(F.split(path, "/"), -1)


def is_rul_name(name: Column) -> Column:
    return F.contains(F.upper(name), F.lit("RUL"))


def _bad_tokens() -> Column:
    # the whole array is cast in compiled code; a function of each token would be interpreted
    return F.size("tokens") - F.size(F.array_compact(F.col("tokens").try_cast("array<double>")))


def validate_files(
    lines: DataFrame, columns: Sequence[str] = RAW_COLUMNS, name: Column | None = None
) -> DataFrame:
    """One row per data set and rule: violations in raw lines (file, block, row, tokens).

    Data sets whose name contains RUL hold one value of remaining life per line, the others
    telemetry. A cycle may not be smaller than the one before it of the same unit in line order:
    neighbours inside a block of a file are compared in windows that the block bounds, and the
    seam between blocks on one row per (data set, unit, block). All rules share one scan and one
    shuffle of a few narrow columns.
    """

    def token(i: int) -> Column:
        return F.get("tokens", F.lit(i))

    rul = F.col("_rul")
    rows = (
        lines.withColumn("name", file_name() if name is None else name)
        .withColumn("_rul", is_rul_name(F.col("name")))
        .select(
            "name",
            "_rul",
            "file",
            "block",
            "row",
            F.when(~rul, token(columns.index("unit"))).alias("_unit"),
            F.when(~rul, token(columns.index("cycle")).try_cast("double")).alias("_cycle"),
            (F.size("tokens") != F.when(rul, 1).otherwise(len(columns))).alias("_shape"),
            _bad_tokens().alias("_words"),
            (rul & (token(0).try_cast("double") < 0)).alias("_negative"),
        )
    )
    in_block = Window.partitionBy("name", "_rul", "_unit", "file", "block").orderBy("row")
    seams = Window.partitionBy("name", "_rul", "_unit").orderBy("file", "block")
    blocks = (
        rows.withColumn("_previous", F.lag("_cycle").over(in_block))
        .groupBy("name", "_rul", "_unit", "file", "block")
        .agg(
            F.count_if("_shape").alias("_shape"),
            F.sum("_words").alias("_words"),
            F.count_if("_negative").alias("_negative"),
            F.count_if(F.col("_previous") > F.col("_cycle")).alias("_inside"),
            F.min_by("_cycle", "row").alias("_first"),
            F.max_by("_cycle", "row").alias("_last"),
        )
    )
    crossed = F.coalesce((F.lag("_last").over(seams) > F.col("_first")).cast("int"), F.lit(0))
    counts = (
        blocks.withColumn("_crossed", crossed)
        .groupBy("name", "_rul")
        .agg(
            F.sum("_shape").alias("column_count"),
            F.sum("_words").alias("numeric"),
            F.sum(F.col("_inside") + F.col("_crossed")).alias("monotonic_cycle"),
            F.sum("_negative").alias("non_negative"),
        )
    )
    rules = F.when(rul, F.array(*map(F.lit, RUL_RULES))).otherwise(F.array(*map(F.lit, MAIN_RULES)))
    names = dict.fromkeys(MAIN_RULES + RUL_RULES)
    return (
        counts.withColumn("_rules", rules)
        .unpivot(["name", "_rules"], [F.col(r).cast("bigint").alias(r) for r in names], "rule", "violations")
        .where(F.array_contains("_rules", F.col("rule")))
        .select("name", "rule", "violations", (F.col("violations") == 0).alias("passed"))
    )


def validation_status(report: DataFrame) -> DataFrame:
    """One row: ``passed`` or ``failed``, the number of files, and the first failure."""
    failure = F.concat("name", F.lit(": "), "rule", F.lit(" has "), "violations", F.lit(" violations"))
    one = report.agg(
        F.countDistinct("name").alias("files"),
        F.min(F.when(~F.col("passed"), F.struct("name", "rule", failure.alias("text")))).alias("bad"),
    )
    failed = (F.col("files") == 0) | F.col("bad").isNotNull()
    return one.select(
        F.when(failed, "failed").otherwise("passed").alias("status"),
        "files",
        F.when(F.col("files") == 0, F.lit("no data files found"))
        .otherwise(F.col("bad.text"))
        .alias("error"),
    )


def validated_files(report: DataFrame) -> DataFrame:
    """Names of the files without a violation, one row each."""
    return report.groupBy("name").agg(F.bool_and("passed").alias("passed")).where("passed").select("name")


def window_fits(windows: Column | str, window: int, width: int) -> Column:
    """A nested window has exactly ``window`` rows of ``width`` values."""
    windows = F.col(windows) if isinstance(windows, str) else windows
    return (F.size(windows) == window) & F.forall(windows, lambda row: F.size(row) == width)


def stored_vector_fits(features: Column | str, window: int, width: int) -> Column:
    """A flat stored vector of another length counts as missing."""
    return F.size(features) == window * width


def missing_keys(readings: Column | str, required: Sequence[str]) -> Column:
    """Required sensor names that a reading map does not have."""
    readings = F.col(readings) if isinstance(readings, str) else readings
    return F.array_except(F.array(*[F.lit(r) for r in required]), F.map_keys(readings))


def accepted_readings(log: DataFrame, required: Sequence[str], column: str = "reading") -> DataFrame:
    return log.where(F.size(missing_keys(column, required)) == 0)


def rejected_readings(log: DataFrame, required: Sequence[str], column: str = "reading") -> DataFrame:
    missing = missing_keys(column, required)
    return log.withColumn("missing", missing).where(F.size("missing") > 0)

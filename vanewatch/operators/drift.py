"""Sensor drift between a reference and a current sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewatch.functions.kolmogorov import ks_p_value
from vanewatch.operators.ordering import Before, running
from vanewatch.operators.prepare import missing_columns
from vanewatch.session import materialized
from vanewatch.spec import (
    DRIFT_CRITICAL_SHARE,
    DRIFT_MIN_ROWS,
    DRIFT_P,
    DRIFT_WARNING_SHARE,
    KEEP_SENSORS,
    ROWS_PER_SLICE,
)

_REPORT = "sensor STRING, n_reference BIGINT, n_current BIGINT, statistic DOUBLE, p_value DOUBLE, drifted BOOLEAN"


def common_sensors(reference: DataFrame, current: DataFrame, sensors: Sequence[str] = KEEP_SENSORS) -> list[str]:
    known = [s for s in sensors if s in reference.columns]
    return [s for s in known if s in current.columns]


def missing_sensors(reference: DataFrame, current: DataFrame, sensors: Sequence[str] = KEEP_SENSORS) -> list[str]:
    """Sensors of the reference that the current data lacks."""
    return missing_columns(current, [s for s in sensors if s in reference.columns])


def value_counts(readings: DataFrame, sensors: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, sensor, value, n): how often each value occurs; missing values dropped.

    Counts of parts add up to the counts of the whole, and can be taken away again.
    """
    cols = [F.col(s).cast("double").alias(s) for s in sensors]
    rows = readings.select(*by, *cols).unpivot(list(by), list(sensors), "sensor", "value")
    known = rows.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return known.groupBy(*by, "sensor", "value").agg(F.count(F.lit(1)).alias("n"))


def added_up(*signed: tuple[int, DataFrame]) -> DataFrame:
    """Counts of several parts together, each times its sign; values that are gone drop out."""
    total = None
    for sign, counts in signed:
        part = counts.select("sensor", "value", (F.lit(sign) * F.col("n")).alias("n"))
        total = part if total is None else total.unionAll(part)
    return total.groupBy("sensor", "value").agg(F.sum("n").alias("n")).where(F.col("n") != 0)


def ks_report(
    reference: DataFrame,
    current: DataFrame,
    sensors: Sequence[str] = KEEP_SENSORS,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Two-sample KS statistic, p-value and drift flag per common sensor.

    Rows are first counted per distinct value, so equal readings meet before the shuffle.
    Sensors with an empty side are left out.
    """
    available = common_sensors(reference, current, sensors)
    if not available:
        return reference.sparkSession.createDataFrame([], _REPORT)
    return ks_from_counts(value_counts(reference, available), value_counts(current, available), rows_per_slice)


def ks_from_counts(reference: DataFrame, current: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """The same from value counts of both sides.

    The counts are written once, and the cumulative counts run over slices of the value range.
    """
    none = F.lit(0).cast("bigint")
    sides = reference.select("sensor", "value", F.col("n").alias("r"), none.alias("c")).unionAll(
        current.select("sensor", "value", none.alias("r"), F.col("n").alias("c"))
    )
    both = sides.groupBy("sensor", "value").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    counts = materialized(both, "value-counts")
    totals = counts.groupBy("sensor").agg(F.sum("r").alias("n"), F.sum("c").alias("m"))
    cumulative = running(
        counts, ["sensor"], ["value"], {"r0": Before("sum", "r"), "c0": Before("sum", "c")}, rows_per_slice
    )
    # at most one row per sensor on the right side
    both = cumulative.join(F.broadcast(totals), "sensor").where((F.col("n") > 0) & (F.col("m") > 0))
    gap = F.abs((F.col("r0") + F.col("r")) / F.col("n") - (F.col("c0") + F.col("c")) / F.col("m"))
    report = both.groupBy("sensor").agg(
        F.first("n").alias("n_reference"), F.first("m").alias("n_current"), F.max(gap).alias("statistic")
    )
    return with_drift_flag(report)


def with_drift_flag(report: DataFrame, limit: float = DRIFT_P) -> DataFrame:
    p = ks_p_value(F.col("statistic"), F.col("n_reference"), F.col("n_current"))
    return report.withColumn("p_value", p).withColumn("drifted", F.col("p_value") < limit)


def alert_level(share: Column) -> Column:
    return (
        F.when(share > DRIFT_CRITICAL_SHARE, "CRITICAL").when(share > DRIFT_WARNING_SHARE, "WARNING").otherwise("OK")
    )


def drift_summary(report: DataFrame, available: Sequence[str], missing: Sequence[str] = ()) -> DataFrame:
    """One row: share of drifted sensors among the available ones, and the level.

    Without any common sensor the level is ERROR. The lists hold at most one entry per sensor.
    """
    names = F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("sensor"))))
    one = report.agg(names.alias("drifted_features"))
    total = len(available)
    share = F.size("drifted_features") / F.lit(float(total or 1))
    level = alert_level(share) if total else F.lit("ERROR")
    lost = F.array(*[F.lit(m) for m in sorted(missing)]).cast("array<string>") if total else F.lit([]).cast("array<string>")
    return one.select(
        (share > DRIFT_WARNING_SHARE).alias("drift_detected"),
        F.bround(share, 4).alias("drift_share"),
        "drifted_features",
        F.lit(total).cast("bigint").alias("total_features"),
        lost.alias("missing_features"),
        level.alias("alert_level"),
    )


def report_and_summary(
    reference: DataFrame,
    current: DataFrame,
    sensors: Sequence[str] = KEEP_SENSORS,
    min_rows: int = DRIFT_MIN_ROWS,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> tuple[DataFrame, DataFrame]:
    """Rows per sensor, and one summary row; no summary below ``min_rows`` current rows."""
    report = ks_report(reference, current, sensors, rows_per_slice)
    summary = drift_summary(
        report, common_sensors(reference, current, sensors), missing_sensors(reference, current, sensors)
    )
    enough = current.agg(F.count(F.lit(1)) >= min_rows).scalar()
    return report, summary.where(enough)


def check_drift(reference: DataFrame, current: DataFrame, sensors: Sequence[str] = KEEP_SENSORS, **settings) -> DataFrame:
    return report_and_summary(reference, current, sensors, **settings)[1]


def check_recent(
    reference: DataFrame,
    history: DataFrame,
    time: str,
    since: Column,
    until: Column,
    sensors: Sequence[str] = KEEP_SENSORS,
) -> DataFrame:
    """Scheduled check of the readings in [since, until) against the reference."""
    recent = history.where((F.col(time) >= since) & (F.col(time) < until))
    return check_drift(reference, recent, sensors)


def append_report(report: DataFrame, summary: DataFrame, checked_at: Column, tick: int, path: str) -> None:
    """Rows per sensor by day and tick, when drift was detected; a tick that is repeated replaces its rows."""
    drifted = summary.agg(F.coalesce(F.bool_or("drift_detected"), F.lit(False))).scalar()
    (
        report.where(drifted)
        .withColumns({"checked_at": checked_at, "date": F.to_date(checked_at), "tick": F.lit(tick).cast("bigint")})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "tick")
        .parquet(path)
    )

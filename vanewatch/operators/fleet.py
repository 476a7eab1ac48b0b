"""Fleet indicators, risk lists and alerts over prediction records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewatch.functions.scalars import band_rank, threshold_rank
from vanewatch.operators.ordering import Before, running
from vanewatch.spec import ENGINE_PREFIX, RISK_LEVELS, ROWS_PER_SLICE


def fleet_kpi(predictions: DataFrame) -> DataFrame:
    level = F.col("risk_level")
    return predictions.agg(
        F.count(F.lit(1)).alias("active_engines"),
        F.count_if(level == "CRITICAL").alias("critical_engines"),
        F.count_if(level == "HIGH").alias("high_engines"),
        F.coalesce(F.round(F.avg("remaining_cycles")), F.lit(0.0)).cast("bigint").alias("avg_rul"),
    )


def risk_distribution(predictions: DataFrame) -> DataFrame:
    """Count per band, empty bands included."""
    counts = predictions.agg(
        *[F.count_if(F.col("risk_level") == level).alias(level) for level in RISK_LEVELS]
    )
    return counts.unpivot([], list(RISK_LEVELS), "risk_level", "engines")


def average_cycle(telemetry: DataFrame) -> DataFrame:
    average = F.coalesce(F.round(F.avg("cycle")), F.lit(0.0))
    return telemetry.agg(F.count(F.lit(1)).alias("engines"), average.cast("bigint").alias("avg_cycle"))


def by_risk(predictions: DataFrame) -> DataFrame:
    """Riskiest first; ties by engine."""
    return predictions.orderBy(F.col("failure_risk").desc(), "engine_id")


def top_risk(predictions: DataFrame, n: int = 15) -> DataFrame:
    """Bar-chart rows of the ``n`` riskiest engines, ids without their prefix."""
    return by_risk(predictions).limit(n).select(
        F.replace("engine_id", F.lit(ENGINE_PREFIX), F.lit("")).alias("engine"),
        "remaining_cycles",
        "risk_level",
    )


def search(predictions: DataFrame, text: str = "", level: str = "ALL") -> DataFrame:
    """Engines whose id contains ``text`` in any case, at exactly one level unless ALL."""
    found = predictions
    if text:
        found = found.where(F.contains(F.lower("engine_id"), F.lit(text.lower())))
    if level != "ALL":
        found = found.where(F.col("risk_level") == level)
    return by_risk(found)


def at_least(predictions: DataFrame, level: str | None = "HIGH") -> DataFrame:
    return predictions.where(band_rank("risk_level") >= threshold_rank(level))


def alerts(predictions: DataFrame, level: str | None = "HIGH") -> DataFrame:
    return by_risk(at_least(predictions, level))


def newest(rows: DataFrame, n: int, time: str = "timestamp", tie: str = "id") -> DataFrame:
    return rows.orderBy(F.col(time).desc(), tie).limit(n)


def open_alerts(alert_rows: DataFrame, n: int = 8) -> DataFrame:
    return newest(alert_rows.where(~F.col("acknowledged")), n)


def alert_id(engine: Column, timestamp: Column) -> Column:
    return F.concat_ws("-", engine, timestamp.cast("string"))


def deduplicated_alerts(
    log: DataFrame,
    order: Sequence[str],
    is_alert: str = "is_alert",
    is_ack: str = "is_ack",
    key: str = "engine_id",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Alerts that open while the engine has no open one; an acknowledgement closes it.

    The acknowledgements before a row number the epochs of an engine. The first alert row of an
    epoch opens an alert, and the acknowledgement that ends the epoch closes it. ``order`` is the
    order of the log, with unique values; ``log`` should be a stored table.
    """
    acks = F.when(F.col(is_ack), F.lit(1)).otherwise(F.lit(0))
    epochs = running(log, [key], order, {"epoch": Before("sum", acks)}, rows_per_slice)
    rest = [c for c in log.columns if c not in (key, is_alert, is_ack)]
    place = F.when(F.col(is_alert), F.struct(*order))
    return (
        epochs.groupBy(key, F.col("epoch").cast("bigint").alias("epoch"))
        .agg(F.min_by(F.struct(*rest), place).alias("_first"), F.bool_or(is_ack).alias("acknowledged"))
        .where(F.col("_first").isNotNull())
        .select(key, "epoch", "_first.*", "acknowledged")
    )

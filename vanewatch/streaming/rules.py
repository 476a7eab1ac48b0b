"""Alert rules as streams: a quantile per window, and sessions of neighbouring windows above a limit."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def interpolated(counts: Sequence[Column], bounds: Sequence[float], q: float) -> Column:
    """Quantile from cumulative counts side by side, one per bound and the whole count last.

    The rules are those of ``monitoring.histogram_quantiles``.
    """
    total = counts[-1]
    rank = F.lit(float(q)) * total
    value = F.when(total == 0, F.lit(None).cast("double"))
    for i, bound in enumerate(bounds):
        low, below = (bounds[i - 1], counts[i - 1]) if i else (0.0, F.lit(0))
        if not i and bound <= 0:
            value = value.when(counts[i] >= rank, F.lit(float(bound)))
            continue
        part = (rank - below) / F.nullif((counts[i] - below).cast("double"), F.lit(0.0))
        inside = F.coalesce(F.lit(float(low)) + (bound - low) * part, F.lit(float(low)))
        value = value.when(counts[i] >= rank, inside)
    return value.otherwise(F.lit(float(bounds[-1])))


def quantile_alerts(
    log: DataFrame,
    ts: str,
    value: str,
    bounds: Sequence[float],
    groups: Sequence[str],
    q: float,
    limit: float,
    hold_seconds: int,
    step_seconds: int,
    late: str = "10 minutes",
) -> DataFrame:
    """Stretches in which a quantile stays above a limit for ``hold_seconds``: groups, since, until, windows, peak.

    A stretch is reported once, when the watermark has passed the window after it. State holds a row of
    counts per group and open window, and one row per group and open stretch.
    """
    bounds = [float(b) for b in bounds if b != math.inf]
    names = [f"_b{i}" for i in range(len(bounds))]
    counted = (
        log.withWatermark(ts, late)
        .groupBy(F.window(ts, f"{step_seconds} seconds").alias("window"), *groups)
        .agg(*[F.count_if(F.col(value) <= b).alias(n) for n, b in zip(names, bounds, strict=True)], F.count(value).alias("_all"))
    )
    quantile = interpolated([F.col(n) for n in (*names, "_all")], bounds, q)
    high = counted.select(*groups, "window", quantile.alias("quantile")).where(F.col("quantile") > limit)
    # window times of neighbours lie one step apart, which a session one second longer joins
    session = F.session_window(F.window_time("window"), f"{step_seconds + 1} seconds")
    stretches = high.groupBy(session.alias("session"), *groups).agg(
        F.count(F.lit(1)).alias("windows"),
        F.min("window.start").alias("since"),
        F.max("window.end").alias("until"),
        F.max("quantile").alias("peak"),
    )
    long = stretches.where(F.col("windows") * step_seconds >= hold_seconds)
    return long.select(*groups, "since", "until", "windows", "peak")

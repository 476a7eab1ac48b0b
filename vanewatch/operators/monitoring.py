"""Queries over metric samples and prediction logs."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vanewatch.operators.ordering import Before, running
from vanewatch.session import materialized
from vanewatch.spec import ROWS_PER_SLICE

#: Size of quantile sketches: the rank of a quantile is off by less than one percent of the rows.
SKETCH_K = 400

# After time-bucketing, a series has one row per time step. Windows over such rows are bounded by
# the length of the time range, not by the data, and use plain partitions.


def time_bucket(ts: str, step: str) -> Column:
    """Start of the time window a sample falls into."""
    return F.window(ts, step)["start"]


# --- counters ----------------------------------------------------------------------------------


def counter_increase(
    samples: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    value: str = "value",
    out: str = "increase",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Growth since the previous sample of the series; after a reset the value itself.

    The first sample of a series has no growth (NULL).
    """
    lagged = running(samples, series, order, {"_prev": Before("lag", value)}, rows_per_slice)
    now, before = F.col(value), F.col("_prev")
    growth = F.when(before.isNull(), F.lit(None)).when(now >= before, now - before).otherwise(now)
    return lagged.withColumn(out, growth).drop("_prev")


def counter_rate(
    samples: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    value: str,
    seconds: int,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Increase per second of each series and time window; ``order[0]`` is the sample time."""
    grown = counter_increase(samples, series, order, value, rows_per_slice=rows_per_slice)
    return (
        grown.groupBy(*series, time_bucket(order[0], f"{seconds} seconds").alias("window_start"))
        .agg((F.coalesce(F.sum("increase"), F.lit(0)) / F.lit(float(seconds))).alias("rate"))
    )


def busy_percent(rates: DataFrame, by: Sequence[str] = ("instance",), rate: str = "rate") -> DataFrame:
    """CPU use from the rate of idle seconds per core: 100 minus the average idle share."""
    return rates.groupBy(*by).agg((100.0 - F.avg(rate) * 100.0).alias("percent"))


def throughput(log: DataFrame, ts: str, seconds: int, labels: Sequence[str] = ()) -> DataFrame:
    """Log rows per second in each window, by label."""
    return log.groupBy(time_bucket(ts, f"{seconds} seconds").alias("window_start"), *labels).agg(
        (F.count(F.lit(1)) / F.lit(float(seconds))).alias("rate")
    )


def labelled_counts(log: DataFrame, labels: Sequence[str]) -> DataFrame:
    return log.groupBy(*labels).agg(F.count(F.lit(1)).alias("total"))


# --- histograms and quantiles --------------------------------------------------------------------


def histogram_buckets(
    log: DataFrame, value: str, bounds: Sequence[float], groups: Sequence[str] = ()
) -> DataFrame:
    """Cumulative counts per upper bound ``le``, the last one infinite; one pass, no row blow-up."""
    bounds = [float(b) for b in bounds]
    names = [f"_b{i}" for i in range(len(bounds))]
    counts = log.groupBy(*groups).agg(
        *[F.count_if(F.col(value) <= b).alias(n) for n, b in zip(names, bounds)],
        F.count(value).alias("_all"),
    )
    entry = [
        F.struct(F.lit(b).alias("le"), F.col(n).alias("cumulative"))
        for n, b in zip([*names, "_all"], [*bounds, math.inf])
    ]
    return counts.select(*groups, F.inline(F.array(*entry)))


def histogram_quantiles(buckets: DataFrame, quantiles: dict[str, float], groups: Sequence[str] = ()) -> DataFrame:
    """Linear interpolation inside the first bucket that reaches the rank; all quantiles in one pass.

    A rank in the infinite bucket gives the largest finite bound; the first bucket starts at zero
    unless its bound is not positive. Groups without observations give NULL.
    """
    # a group has one row per bound
    group = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(1))
    up = group.orderBy("le")
    placed = buckets.withColumns(
        {
            "_total": F.max("cumulative").over(group),
            "_low": F.lag("le").over(up),
            "_below": F.coalesce(F.lag("cumulative").over(up), F.lit(0)),
        }
    )
    hits, values = [], []
    for name, q in quantiles.items():
        rank = F.lit(float(q)) * F.col("_total")
        hit = F.when(F.col("cumulative") >= rank, F.struct("le", "_low", "_below", "cumulative", rank.alias("_rank")))
        hits.append(F.min(hit).alias(f"_{name}"))
        h = F.col(f"_{name}")
        start = F.coalesce(h["_low"], F.lit(0.0))
        inside = start + (h["le"] - start) * (h["_rank"] - h["_below"]) / F.nullif(
            (h["cumulative"] - h["_below"]).cast("double"), F.lit(0.0)
        )
        value = (
            F.when(F.col("total") == 0, F.lit(None))
            .when(h["le"] == math.inf, h["_low"])
            .when(h["_low"].isNull() & (h["le"] <= 0), h["le"])
            .otherwise(F.coalesce(inside, start))
        )
        values.append(value.alias(name))
    return placed.groupBy(*groups).agg(*hits, F.max("cumulative").alias("total")).select(*groups, *values)


def histogram_quantile(buckets: DataFrame, q: float, groups: Sequence[str] = (), out: str = "quantile") -> DataFrame:
    return histogram_quantiles(buckets, {out: q}, groups)


def quantile_rule(
    samples: DataFrame,
    groups: Sequence[str],
    series: Sequence[str],
    order: Sequence[str],
    q: float,
    limit: float,
    hold_seconds: int,
    step_seconds: int,
    value: str = "value",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """When a quantile of histogram counters stayed above a limit: groups, since, until, windows, peak.

    Counters may reset. Their growth is added up per group, window and bound ``le``, the quantile is
    interpolated per window, and windows above the limit that follow one another without a break, for at
    least ``hold_seconds``, make a stretch. Windows without observations have no quantile and end one.
    """
    grown = counter_increase(samples, [*series, "le"], order, value, rows_per_slice=rows_per_slice)
    window = time_bucket(order[0], f"{step_seconds} seconds").alias("window_start")
    growth = grown.groupBy(*groups, window, "le").agg(F.coalesce(F.sum("increase"), F.lit(0)).alias("cumulative"))
    values = histogram_quantiles(growth, {"quantile": q}, [*groups, "window_start"])
    return sustained(values, F.col("quantile") > limit, hold_seconds, step_seconds, groups, F.max("quantile").alias("peak"))


def exact_quantiles(
    log: DataFrame,
    value: str,
    quantiles: dict[str, float],
    groups: Sequence[str] = (),
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Interpolated quantiles without gathering a group: count equal values, then find the ranks."""
    counted = (
        log.where(F.col(value).isNotNull())
        .groupBy(*groups, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    counts = materialized(counted, "value-counts")
    ranked = running(counts, groups, ["_v"], {"_before": Before("sum", "_c")}, rows_per_slice)
    size = counts.groupBy(*groups).agg(F.sum("_c").alias("_n"))
    if groups:
        joined = ranked.join(materialized(size, "group-sizes"), list(groups))
    else:
        joined = ranked.withColumn("_n", size.scalar())
    reached = F.col("_before") + F.col("_c")

    def at(rank: Column) -> Column:
        return F.min(F.when(reached > rank, F.col("_v")))

    aggs = []
    for name, q in quantiles.items():
        rank = F.lit(float(q)) * (F.col("_n") - 1)
        aggs += [at(F.floor(rank)).alias(f"{name}_lo"), at(F.ceil(rank)).alias(f"{name}_hi")]
        aggs.append(F.max(rank - F.floor(rank)).alias(f"{name}_part"))
    values = [
        (F.col(f"{n}_lo") + (F.col(f"{n}_hi") - F.col(f"{n}_lo")) * F.col(f"{n}_part")).alias(n) for n in quantiles
    ]
    return joined.groupBy(*groups).agg(*aggs).select(*groups, *values)


def hourly_sketches(log: DataFrame, value: str, ts: str, groups: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """A quantile sketch of known size per group and hour: (groups, hour, n, sketch), to be stored.

    Sketches of any hours merge into one as good as if made from all their values at once.
    """
    known = log.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    hour = time_bucket(ts, "1 hour").alias("hour")
    sketch = F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch")
    return known.groupBy(*groups, hour).agg(F.count(F.lit(1)).alias("n"), sketch)


def merged_quantiles(
    sketches: DataFrame, quantiles: dict[str, float], groups: Sequence[str] = (), k: int = SKETCH_K
) -> DataFrame:
    """Quantiles of all hours given, from their sketches alone: (groups, n, quantiles)."""
    merged = sketches.groupBy(*groups).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("_s"))
    values = [F.kll_sketch_get_quantile_double("_s", F.lit(float(q))).alias(name) for name, q in quantiles.items()]
    return merged.select(*groups, "n", *values)


# --- time grids ----------------------------------------------------------------------------------


def time_spine(samples: DataFrame, ts: str, step: str, labels: Sequence[str] = ()) -> DataFrame:
    """Every window start between the first and the last sample of the whole log, per label."""
    start = time_bucket(ts, step)
    whole = samples.agg(F.min(start).alias("lo"), F.max(start).alias("hi"))
    lo, hi = whole.select("lo").scalar(), whole.select("hi").scalar()
    base = samples.select(*labels).distinct() if labels else whole
    grid = F.explode(F.sequence(lo, hi, F.expr(f"INTERVAL '{step.split()[0]}' {step.split()[1]}")))
    return base.select(*labels, grid.alias("window_start"))


def default_zero(spine: DataFrame, measured: DataFrame, value: str, labels: Sequence[str] = ()) -> DataFrame:
    """A value for every window: zero where nothing was measured."""
    joined = spine.join(measured, [*labels, "window_start"], "left")
    return joined.withColumn(value, F.coalesce(value, F.lit(0.0)))


def silent_windows(
    samples: DataFrame, ts: str, step: str, labels: Sequence[str] = ()
) -> DataFrame:
    """Windows in which a source sent nothing, between the first and the last window of the whole log.

    Neighbouring windows of a source are compared, and only the gaps between them are expanded.
    """
    seen = samples.select(*labels, time_bucket(ts, step).alias("window_start")).distinct()
    whole = samples.agg(F.min(time_bucket(ts, step)).alias("lo"), F.max(time_bucket(ts, step)).alias("hi"))
    lo, hi = whole.select("lo").scalar(), whole.select("hi").scalar()
    width = F.expr(f"INTERVAL '{step.split()[0]}' {step.split()[1]}")
    # a source has one row per window: bounded by the time range
    order = Window.partitionBy(*labels or [F.lit(1)]).orderBy("window_start")
    now = F.col("window_start")
    gaps = seen.withColumns({"_before": F.lag(now).over(order), "_after": F.lead(now).over(order)}).select(
        *labels,
        F.coalesce(F.col("_before") + width, lo).alias("_from"),
        (now - width).alias("_to"),
        F.when(F.col("_after").isNull() & (now < hi), now + width).alias("_rest"),
    )
    ahead = F.when(F.col("_from") <= F.col("_to"), F.sequence("_from", "_to", width))
    behind = F.when(F.col("_rest").isNotNull(), F.sequence("_rest", hi, width))
    none = F.array().cast(f"array<{dict(seen.dtypes)['window_start']}>")
    missing = F.concat(F.coalesce(ahead, none), F.coalesce(behind, none))
    return gaps.where((F.col("_from") <= F.col("_to")) | F.col("_rest").isNotNull()).select(
        *labels, F.explode(missing).alias("window_start")
    )


def sustained(
    grid: DataFrame,
    condition: Column,
    hold_seconds: int,
    step_seconds: int,
    series: Sequence[str] = (),
    *measures: Column,
) -> DataFrame:
    """Stretches of consecutive windows where ``condition`` holds for at least ``hold_seconds``.

    ``grid`` has one row per series and ``window_start``; a gap in the grid ends a stretch. ``measures`` are
    further aggregates of a stretch.
    """
    order = Window.partitionBy(*series or [F.lit(1)]).orderBy("window_start")
    step = F.make_dt_interval(secs=F.lit(step_seconds))
    held = grid.where(condition)
    starts = F.coalesce(F.col("window_start") - F.lag("window_start").over(order) != step, F.lit(True))
    islands = held.withColumn("_starts", starts.cast("int")).withColumn(
        "_island", F.sum("_starts").over(order)
    )
    rows = F.count(F.lit(1))
    return (
        islands.groupBy(*series, "_island")
        .agg(
            F.min("window_start").alias("since"), (F.max("window_start") + step).alias("until"), rows.alias("windows"),
            *measures,
        )
        .where(F.col("windows") * step_seconds >= hold_seconds)
        .drop("_island")
    )


# --- gauges --------------------------------------------------------------------------------------


def gauge_ratio(
    samples: DataFrame,
    top: str,
    bottom: str,
    keys: Sequence[str] = ("ts", "instance"),
    metric: str = "metric",
    value: str = "value",
) -> DataFrame:
    """Percent of one gauge in another at the same time and place, NULL for a zero base."""
    wanted = samples.where(F.col(metric).isin(top, bottom))
    pair = wanted.groupBy(*keys).agg(
        F.max(F.when(F.col(metric) == top, F.col(value))).alias("_top"),
        F.max(F.when(F.col(metric) == bottom, F.col(value))).alias("_bottom"),
    )
    complete = pair.where(F.col("_top").isNotNull() & F.col("_bottom").isNotNull())
    percent = F.col("_top") / F.nullif(F.col("_bottom").cast("double"), F.lit(0.0)) * 100.0
    return complete.select(*keys, percent.alias("percent"))


def above(ratios: DataFrame, limit: float, by: Sequence[str] = ("instance",)) -> DataFrame:
    """Average percentage per instance, and whether it exceeds the limit."""
    return ratios.groupBy(*by).agg(F.avg("percent").alias("percent")).withColumn("firing", F.col("percent") > limit)

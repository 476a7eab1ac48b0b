"""Queries over drift and metric samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewatch.operators import drift, monitoring
from vanewatch.operators.ordering import Before, running
from vanewatch.plans.registry import query
from vanewatch.plans.series import rounded
from vanewatch.plans.testviews import MIDDLE, events, ntz, predictions, sensor, sql, stamp
from vanewatch.session import materialized
from vanewatch.spec import HISTOGRAM_BOUNDS, KEEP_SENSORS

# --- drift ---------------------------------------------------------------------------------------

# In the current half five sensors are shifted, one by little, and s21 is gone.
SHIFT = {"s2": 6.0, "s3": 10.0, "s4": 15.0, "s7": 40.0, "s9": 1.0}
CURRENT = [s for s in KEEP_SENSORS if s != "s21"]


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    return rows.select("ts", *[sensor(s).alias(s) for s in KEEP_SENSORS])


def halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = readings(spark, sf_dir)
    current = rows.where(F.col("ts") >= ntz(MIDDLE)).drop("s21")
    return (
        rows.where(F.col("ts") < ntz(MIDDLE)),
        current.withColumns({s: F.col(s) + F.lit(d) for s, d in SHIFT.items()}),
    )


_LONG = " union all ".join(
    f"select '{s}' as sensor, value + {s[1:]}.0::double * k + "
    f"case when ts >= timestamp '{MIDDLE}' then {SHIFT.get(s, 0.0)}::double else 0::double end as v, "
    f"ts >= timestamp '{MIDDLE}' as cur from e"
    for s in CURRENT
)
_CDF = (
    "select sensor, sum(r) over w / sum(r) over a as f, sum(c) over w / sum(c) over a as g, "
    "sum(r) over a as n, sum(c) over a as m from (select sensor, v, count(*) filter (where not cur) as r, "
    "count(*) filter (where cur) as c from lng group by sensor, v) "
    "window w as (partition by sensor order by v rows between unbounded preceding and current row), a as (partition by sensor)"
)
_KS = "select sensor, max(abs(f - g)) as d, cast(any_value(n) as bigint) as n, cast(any_value(m) as bigint) as m from cdf group by sensor"
_P = (
    "select *, case when lam < 0.2 then 1::double else greatest(0::double, least(1::double, 2::double * list_sum(list_transform(range(1, 101), "
    "lambda j: (case when j % 2 = 1 then 1 else -1 end) * exp(-2.0::double * j * j * lam * lam))))) end as p from "
    "(select *, (sqrt(n::double * m / (n + m)) + 0.12::double + 0.11::double / sqrt(n::double * m / (n + m))) * d as lam from ks)"
)
_DRIFT = {"lng": _LONG, "cdf": _CDF, "ks": _KS, "pv": _P}


@query(
    "ks_statistic",
    sql("select sensor, n as n_reference, m as n_current, round(d, 6) as statistic from ks", "e", **_DRIFT),
)
def ks_statistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = drift.ks_report(*halves(spark, sf_dir))
    return rounded(report.select("sensor", "n_reference", "n_current", "statistic"), "statistic")


@query("ks_p_values", sql("select sensor, round(p, 6) as p_value, p < 0.05 as drifted from pv", "e", **_DRIFT))
def ks_p_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = drift.ks_report(*halves(spark, sf_dir))
    return rounded(report.select("sensor", "p_value", "drifted"), "p_value")


@query(
    "drift_summary",
    sql(
        "select share > 0.3 as drift_detected, round_even(share, 4) as drift_share, names as drifted_features, "
        f"cast({len(CURRENT)} as bigint) as total_features, 's21' as missing_features, "
        "case when share > 0.5 then 'CRITICAL' when share > 0.3 then 'WARNING' else 'OK' end as alert_level from "
        f"(select count(*) filter (where p < 0.05) / {len(CURRENT)}.0::double as share, "
        "string_agg(sensor, ',' order by sensor) filter (where p < 0.05) as names from pv)",
        "e",
        **_DRIFT,
    ),
)
def drift_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = drift.check_drift(*halves(spark, sf_dir))
    return summary.withColumns(
        {c: F.array_join(c, ",") for c in ("drifted_features", "missing_features")}
    )


_RECENT_END = "2024-01-20 00:00:00"
_RECENT = _DRIFT | {"lng": f"select * from ({_LONG.replace(' as cur from e', ' as cur, ts from e')}) "
                           f"where ts < timestamp '{_RECENT_END}'"}


@query(
    "drift_recent_days",
    sql(
        "select round_even(share, 4) as drift_share, drifted, "
        "case when share > 0.5 then 'CRITICAL' when share > 0.3 then 'WARNING' else 'OK' end as alert_level from "
        f"(select count(*) filter (where p < 0.05) as drifted, count(*) filter (where p < 0.05) / {len(CURRENT)}.0::double as share from pv) "
        f"where (select count(*) from e where ts >= timestamp '{MIDDLE}' and ts < timestamp '{_RECENT_END}') >= 100",
        "e",
        **_RECENT,
    ),
)
def drift_recent_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check of four days against the first half."""
    reference, current = halves(spark, sf_dir)
    checked = drift.check_recent(reference, current, "ts", ntz(MIDDLE), ntz(_RECENT_END))
    drifted = F.size("drifted_features").cast("bigint").alias("drifted")
    return checked.select("drift_share", drifted, "alert_level")


# --- monitoring ----------------------------------------------------------------------------------

HOUR = 3600
_HOUR = "date_trunc('hour', ts)"


def _stamped(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: stamp(c) for c in columns or ("window_start",)})


_STAMP = "strftime({x}, '%Y-%m-%d %H:%M:%S')"
_INCREASE = (
    "select *, case when prev is null then null when k >= prev then k - prev else k end as inc from "
    "(select *, lag(k) over (partition by event_type order by ts, event_id) as prev from e)"
)


@query(
    "counter_rate",
    sql(
        f"select event_type, {_STAMP.format(x=_HOUR)} as window_start, round(coalesce(sum(inc), 0) / 3600.0::double, 6) as rate "
        f"from i group by event_type, {_HOUR}",
        "e",
        i=_INCREASE,
    ),
)
def counter_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k as a counter per event type that resets often."""
    samples = events(spark, sf_dir).select("event_type", "ts", "event_id", "k")
    rates = monitoring.counter_rate(samples, ["event_type"], ["ts", "event_id"], "k", HOUR)
    return rounded(_stamped(rates), "rate")


@query(
    "busy_percent",
    sql(
        "select event_type as instance, round(100 - avg(rate) * 100, 6) as percent, 100 - avg(rate) * 100 > 85 as firing from "
        f"(select event_type, {_HOUR} as h, coalesce(sum(inc), 0) / 3600.0::double as rate from i group by 1, 2) group by 1",
        "e",
        i=_INCREASE,
    ),
)
def busy_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k as idle seconds."""
    samples = events(spark, sf_dir).select(F.col("event_type").alias("instance"), "ts", "event_id", "k")
    rates = monitoring.counter_rate(samples, ["instance"], ["ts", "event_id"], "k", HOUR)
    busy = monitoring.busy_percent(rates)
    return rounded(busy.withColumn("firing", F.col("percent") > 85.0), "percent")


@query(
    "sum_by_label",
    sql(
        f"select {_STAMP.format(x=_HOUR)} as window_start, risk_level, round(count(*) / 3600.0::double, 6) as rate from p "
        f"group by {_HOUR}, risk_level",
        "p",
    ),
)
def sum_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = monitoring.throughput(predictions(spark, sf_dir), "ts", HOUR, ["risk_level"])
    return rounded(_stamped(rates), "rate")


@query(
    "labelled_counters",
    sql("select engine_id, risk_level, count(*) as total from p group by engine_id, risk_level", "p"),
)
def labelled_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.labelled_counts(predictions(spark, sf_dir), ["engine_id", "risk_level"])


BOUNDS = HISTOGRAM_BOUNDS["prediction_latency_seconds"]


def latencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds per prediction, by event type and day."""
    return events(spark, sf_dir).select(
        "event_type", F.to_date("ts").cast("string").alias("day"), (F.col("value") / 1000.0).alias("latency")
    )


_LATENCY = "select event_type, cast(cast(ts as date) as varchar) as day, value / 1000.0::double as latency from e"
_BUCKETS = (
    "select event_type, day, le, count(*) filter (where latency <= le) as cumulative from lat, "
    f"(select unnest([{', '.join(f'{b}::double' for b in BOUNDS)}, 'infinity'::double]) as le) group by event_type, day, le"
)


@query(
    "histogram_buckets",
    sql(
        "select event_type, day, case when isinf(le) then '+Inf' else cast(round(le * 1000) as bigint)::varchar end as le_ms, "
        "cumulative from b",
        "e",
        lat=_LATENCY,
        b=_BUCKETS,
    ),
)
def histogram_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = monitoring.histogram_buckets(latencies(spark, sf_dir), "latency", BOUNDS, ["event_type", "day"])
    finite = F.round(F.col("le") * 1000).cast("bigint").cast("string")
    le = F.when(F.col("le") == float("inf"), "+Inf").otherwise(finite)
    return buckets.select("event_type", "day", le.alias("le_ms"), "cumulative")


def _sql_quantile(q: float, name: str) -> str:
    return (
        f"select event_type, day, case when isinf(le) then low else low0 + (le - low0) * ({q}::double * total - below) / "
        f"(cumulative - below) end as {name} from (select *, lag(le) over w as low, coalesce(lag(le) over w, 0) as low0, "
        "coalesce(lag(cumulative) over w, 0) as below, max(cumulative) over (partition by event_type, day) as total from b "
        f"window w as (partition by event_type, day order by le)) where cumulative >= {q}::double * total "
        "qualify row_number() over (partition by event_type, day order by le) = 1"
    )


@query(
    "histogram_quantile",
    sql(
        "select event_type, day, round(p50, 6) as p50, round(p95, 6) as p95 from q50 join q95 using (event_type, day)",
        "e",
        lat=_LATENCY,
        b=_BUCKETS,
        q50=_sql_quantile(0.5, "p50"),
        q95=_sql_quantile(0.95, "p95"),
    ),
)
def histogram_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["event_type", "day"]
    buckets = monitoring.histogram_buckets(latencies(spark, sf_dir), "latency", BOUNDS, keys)
    return rounded(monitoring.histogram_quantiles(buckets, {"p50": 0.5, "p95": 0.95}, keys), "p50", "p95")


@query(
    "latency_quantiles",
    sql(
        "select event_type, round(quantile_cont(value, 0.5), 6) as p50, round(quantile_cont(value, 0.95), 6) as p95, "
        "round(quantile_cont(value, 0.99), 6) as p99 from e group by event_type",
        "e",
    ),
)
def latency_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    values = monitoring.exact_quantiles(events(spark, sf_dir), "value", wanted, ["event_type"])
    return rounded(values, *wanted)


RULE_STEP, RULE_HOLD, RULE_LIMIT = 6 * HOUR, 12 * HOUR, 0.16
_SAMPLES = (
    "select event_type, le, ts, event_id, count(*) filter (where latency <= le) over (partition by event_type, le, epoch "
    "order by ts, event_id rows between unbounded preceding and current row) as counter from "
    "(select event_type, ts, event_id, value / 1000.0::double as latency, count(*) filter (where k < 2) over "
    "(partition by event_type order by ts, event_id rows between unbounded preceding and current row) as epoch from e), "
    f"(select unnest([{', '.join(f'{b}::double' for b in BOUNDS)}, 'infinity'::double]) as le)"
)
_GROWTH = (
    "select event_type, le, time_bucket(interval 6 hours, ts, timestamp '1970-01-01') as w, coalesce(sum(inc), 0) as cumulative from (select *, case when prev is null then null "
    "when counter >= prev then counter - prev else counter end as inc from (select *, lag(counter) over "
    "(partition by event_type, le order by ts, event_id) as prev from smp)) group by 1, 2, 3"
)
RULE_QUANTILES = (
    "select event_type, w, case when isinf(le) then low else low0 + (le - low0) * (0.95::double * total - below) / (cumulative - below) end as q "
    "from (select *, lag(le) over o as low, coalesce(lag(le) over o, 0) as low0, coalesce(lag(cumulative) over o, 0) as below, "
    "max(cumulative) over (partition by event_type, w) as total from grw window o as (partition by event_type, w order by le)) "
    "where total > 0 and cumulative >= 0.95::double * total qualify row_number() over (partition by event_type, w order by le) = 1"
)


def latency_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative counters per event type and bound, one sample an event; they start anew when k is small."""
    log = events(spark, sf_dir).withColumn("latency", F.col("value") / 1000.0)
    order = ["ts", "event_id"]
    epochs = running(log, ["event_type"], order, {"_e": Before("sum", F.when(F.col("k") < 2, 1).otherwise(0))})
    log = epochs.withColumn("epoch", F.col("_e") + F.when(F.col("k") < 2, 1).otherwise(0))
    bounds = F.array(*[F.lit(float(b)) for b in (*BOUNDS, float("inf"))])
    rows = log.select("event_type", "epoch", *order, "latency", F.explode(bounds).alias("le"))
    rows = materialized(rows.withColumn("hit", (F.col("latency") <= F.col("le")).cast("int")), "hits")
    counted = running(rows, ["event_type", "le", "epoch"], order, {"_before": Before("sum", "hit")})
    return counted.select("event_type", "le", *order, (F.col("_before") + F.col("hit")).alias("value"))


@query(
    "latency_rule",
    sql(
        f"select event_type, {_STAMP.format(x='min(w)')} as since, {_STAMP.format(x='max(w) + interval 6 hours')} as until, "
        "count(*) as windows, round(max(q), 6) as peak from (select *, w - interval 6 hours * row_number() over "
        f"(partition by event_type order by w) as island from qt where q > {RULE_LIMIT}) group by event_type, island having count(*) >= 2",
        "e",
        smp=_SAMPLES,
        grw=_GROWTH,
        qt=RULE_QUANTILES,
    ),
)
def latency_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """95 % quantile above the limit for at least two windows of six hours, from counters that reset."""
    samples = materialized(latency_counters(spark, sf_dir), "samples")
    held = monitoring.quantile_rule(
        samples, ["event_type"], ["event_type"], ["ts", "event_id"], 0.95, RULE_LIMIT, RULE_HOLD, RULE_STEP
    )
    return rounded(_stamped(held, "since", "until"), "peak")


_RANGE = ("2024-01-05 06:00:00", "2024-01-25 18:00:00")


@query(
    "sketch_quantiles",
    sql(
        "select event_type, count(*) as n, true as p50_close, true as p95_close from e "
        f"where ts >= timestamp '{_RANGE[0]}' and ts < timestamp '{_RANGE[1]}' group by event_type",
        "e",
    ),
)
def sketch_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty days merged from stored hourly sketches; ranks off by less than one percent and one row."""
    log = events(spark, sf_dir)
    stored = materialized(monitoring.hourly_sketches(log, "value", "ts", ["event_type"]), "sketches")
    wanted = {"p50": 0.5, "p95": 0.95}
    hours = (F.col("hour") >= ntz(_RANGE[0])) & (F.col("hour") < ntz(_RANGE[1]))
    found = monitoring.merged_quantiles(stored.where(hours), wanted, ["event_type"])
    inside = log.where((F.col("ts") >= ntz(_RANGE[0])) & (F.col("ts") < ntz(_RANGE[1])))
    below = [F.sum((F.col("value") < F.col(c)).cast("int")).alias(f"{c}_lt") for c in wanted]
    upto = [F.sum((F.col("value") <= F.col(c)).cast("int")).alias(f"{c}_le") for c in wanted]
    ranks = inside.join(found, "event_type").groupBy("event_type", "n").agg(*below, *upto)
    slack = 0.01 * F.col("n") + 1

    def close(c: str, q: float) -> Column:
        return (F.col(f"{c}_lt") <= q * F.col("n") + slack) & (F.col(f"{c}_le") >= q * F.col("n") - slack)

    return ranks.select("event_type", "n", *[close(c, q).alias(f"{c}_close") for c, q in wanted.items()])


_SPINE = (
    "select unnest(generate_series((select min(date_trunc('hour', ts)) from e), (select max(date_trunc('hour', ts)) from e), "
    "interval 1 hour)) as w"
)
_ERRORS = "select w, count(event_id) / 3600.0::double as rate from spine left join (select * from e where event_type = 'error') x on date_trunc('hour', ts) = w group by w"


def error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events(spark, sf_dir)
    errors = monitoring.throughput(log.where(F.col("event_type") == "error"), "ts", HOUR)
    return monitoring.default_zero(monitoring.time_spine(log, "ts", "1 hour"), errors, "rate")


@query(
    "rate_or_zero",
    sql(f"select {_STAMP.format(x='w')} as window_start, round(rate, 6) as rate from er", "e", spine=_SPINE, er=_ERRORS),
)
def rate_or_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_stamped(error_rates(spark, sf_dir)), "rate")


@query(
    "sustained_alert",
    sql(
        f"select {_STAMP.format(x='min(w)')} as since, {_STAMP.format(x='max(w) + interval 1 hour')} as until, count(*) as windows from "
        "(select w, w - interval 1 hour * row_number() over (order by w) as island from er where rate > 2.0 / 3600) "
        "group by island having count(*) >= 3",
        "e",
        spine=_SPINE,
        er=_ERRORS,
    ),
)
def sustained_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More than two errors per hour for at least three hours."""
    held = monitoring.sustained(error_rates(spark, sf_dir), F.col("rate") > 2.0 / HOUR, 3 * HOUR, HOUR)
    return _stamped(held, "since", "until")


@query(
    "silent_windows",
    sql(
        f"select event_type, {_STAMP.format(x='w')} as window_start from (select distinct event_type from e) cross join spine "
        "except select event_type, " + _STAMP.format(x="date_trunc('hour', ts)") + " from e",
        "e",
        spine=_SPINE,
    ),
)
def silent_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(monitoring.silent_windows(events(spark, sf_dir), "ts", "1 hour", ["event_type"]))


_GAUGES = (
    "select event_type as instance, date_trunc('hour', ts) as h, sum(value) as used, sum(value + k * (case when k > 20 then 1 else 0 end)) as total "
    "from e group by 1, 2"
)


def gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two gauges per instance and hour as metric samples."""
    rows = events(spark, sf_dir)
    k = F.when(F.col("k") > 20, F.col("k")).otherwise(0.0)
    hourly = rows.groupBy(F.col("event_type").alias("instance"), monitoring.time_bucket("ts", "1 hour").alias("ts")).agg(
        F.sum("value").alias("used"), F.sum(F.col("value") + k).alias("total")
    )
    return hourly.unpivot(["ts", "instance"], ["used", "total"], "metric", "value")


@query(
    "gauge_ratio",
    sql(
        f"select instance, {_STAMP.format(x='h')} as ts, round(used / total * 100, 6) as percent from g",
        "e",
        g=_GAUGES,
    ),
)
def gauge_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_stamped(monitoring.gauge_ratio(gauges(spark, sf_dir), "used", "total"), "ts"), "percent")


@query(
    "gauge_threshold",
    sql(
        "select instance, round(avg(used / total * 100), 6) as percent, avg(used / total * 100) > 55 as firing from g group by instance",
        "e",
        g=_GAUGES,
    ),
)
def gauge_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratios = monitoring.gauge_ratio(gauges(spark, sf_dir), "used", "total")
    return rounded(monitoring.above(ratios, 55.0), "percent")

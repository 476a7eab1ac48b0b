"""Registered queries that run as streams over several micro-batches and ticks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewatch.operators import drift
from vanewatch.operators.ordering import latest_per_key
from vanewatch.plans.registry import query
from vanewatch.plans.risk import feature_log
from vanewatch.plans.series import rounded
from vanewatch.plans.testviews import MIDDLE, events, messages, ntz, sql, stamp, telemetry
from vanewatch.plans.watch import (
    BOUNDS,
    CURRENT,
    RULE_HOLD,
    RULE_LIMIT,
    RULE_QUANTILES,
    RULE_STEP,
    SHIFT,
    halves,
    readings,
)
from vanewatch.session import fresh_dir, materialized
from vanewatch.sources import featurelog
from vanewatch.sources.events import dead_letters
from vanewatch.spec import KEEP_SENSORS
from vanewatch.streaming.jobs import monitor_drift
from vanewatch.streaming.rules import quantile_alerts
from vanewatch.streaming.telemetry import telemetry_ticks

DAY_MS = 86_400_000
ORIGIN_MS = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC
TICK_MS, LIVE_MS = DAY_MS, DAY_MS // 2


def landed(spark: SparkSession, rows: DataFrame, time: str, bounds: Sequence[str], name: str) -> Iterator[DataFrame]:
    """Land the rows before each bound, then the rest; after each step the folder as a stream."""
    stored = materialized(rows, f"{name}-source")
    folder = fresh_dir(spark, name)
    edges = [None, *bounds, None]
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        part = stored
        if low:
            part = part.where(F.col(time) >= ntz(low))
        if high:
            part = part.where(F.col(time) < ntz(high))
        part.write.mode("append").parquet(folder)
        yield spark.readStream.schema(stored.schema).parquet(folder)


# --- telemetry ticks -------------------------------------------------------------------------------


@query(
    "stream_telemetry",
    sql(
        f"select {ORIGIN_MS} + k * {TICK_MS} as tick_ms, engine_id, cycle, event_time_ms, 30::bigint as window_size from "
        f"(select *, (ms - {ORIGIN_MS} + {TICK_MS - 1}) // {TICK_MS} as own from w), "
        f"(select unnest(range(1, 400)) as k), (select max(ms) - 600000 as wm from w) "
        f"where own <= k and ms > {ORIGIN_MS} + k * {TICK_MS} - {LIVE_MS} and {ORIGIN_MS} + k * {TICK_MS} < wm "
        "qualify row_number() over (partition by engine_id, k order by ms desc, event_id desc) = 1",
        "t",
        w="select 'ENG-' || unit as engine_id, cycle, event_id, epoch_us(ts) // 1000 as event_time_ms, epoch_us(ts) // 1000 as ms from t",
    ),
)
def stream_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily ticks over four deliveries; engines silent for half a day are missing from a tick."""
    root = fresh_dir(spark, "telemetry")
    time = F.unix_millis(F.col("ts").cast("timestamp"))
    rows = telemetry(spark, sf_dir).select(
        F.concat(F.lit("ENG-"), "unit").alias("engine_id"), "ts", F.col("ts").cast("timestamp").alias("written_at"),
        F.col("event_id").alias("arrival"), "cycle", time.alias("event_time_ms"),
    )
    for stream in landed(spark, rows, "ts", ["2024-01-08 06:00:00", MIDDLE, "2024-01-24 18:00:00"], "writes"):
        (
            telemetry_ticks(stream, TICK_MS, LIVE_MS, origin_ms=ORIGIN_MS)
            .writeStream.format("parquet")
            .option("path", f"{root}/ticks")
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    return spark.read.parquet(f"{root}/ticks")


# --- drift -----------------------------------------------------------------------------------------

_STEPS = ("2024-01-21 00:00:00", "2024-01-26 12:00:00")
DRIFT_DAYS = 7
_ROWS = " union all ".join(
    f"select '{s}' as sensor, value + {s[1:]}.0::double * k + case when ts >= timestamp '{MIDDLE}' then {SHIFT.get(s, 0.0)}::double "
    f"else 0::double end as v, ts from e"
    for s in CURRENT
)
_TICKS = (
    "select tick, cast(max(ts) as date) as last from e, (values (0, timestamp '{a}'), (1, timestamp '{b}'), (2, timestamp '2100-01-01')) t(tick, until) "
    "where ts < until group by tick"
).format(a=_STEPS[0], b=_STEPS[1])
_UNTIL = "case tick when 0 then timestamp '{a}' when 1 then timestamp '{b}' else timestamp '2100-01-01' end".format(a=_STEPS[0], b=_STEPS[1])
_TICK_COUNTS = (
    f"select tick, sensor, v, count(*) filter (where ts < timestamp '{MIDDLE}') as r, count(*) filter (where ts >= timestamp '{MIDDLE}') as c "
    f"from rws, ticks where ts < timestamp '{MIDDLE}' or (cast(ts as date) <= last and cast(ts as date) > last - {DRIFT_DAYS} and ts < {_UNTIL}) "
    "group by tick, sensor, v"
)
_TICK_CDF = (
    "select tick, sensor, sum(r) over w / sum(r) over a as f, sum(c) over w / sum(c) over a as g, sum(r) over a as n, sum(c) over a as m "
    "from counts window w as (partition by tick, sensor order by v), a as (partition by tick, sensor)"
)


@query(
    "stream_drift",
    sql(
        "select tick::bigint as tick, sensor, max(n)::bigint as n_reference, max(m)::bigint as n_current, round(max(abs(f - g)), 6) as statistic "
        "from cdf group by tick, sensor having max(m) > 0",
        "e",
        rws=_ROWS,
        ticks=_TICKS,
        counts=_TICK_COUNTS,
        cdf=_TICK_CDF,
    ),
)
def stream_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second half of the readings in three ticks, the last seven days of each against the first half."""
    root = fresh_dir(spark, "drift")
    first, later = halves(spark, sf_dir)
    reference = materialized(drift.value_counts(first, CURRENT), "reference")
    for stream in landed(spark, later, "ts", _STEPS, "readings"):
        monitor_drift(
            stream, reference, root, f"{root}/checkpoint", DRIFT_DAYS, CURRENT, every=None
        ).awaitTermination()
    report = spark.read.option("basePath", f"{root}/report").parquet(f"{root}/report")
    report = report.select(F.col("batch").cast("bigint").alias("tick"), "sensor", "n_reference", "n_current", "statistic")
    return rounded(report, "statistic")


@query(
    "drift_nothing_to_compare",
    sql(
        "select false as drift_detected, 0::double as drift_share, 0::bigint as total_features, "
        "'ERROR' as alert_level from e having count(*) filter (where ts >= timestamp '" + MIDDLE + "') >= 100",
        "e",
    ),
)
def drift_nothing_to_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current readings have lost all sensors of the reference."""
    rows = readings(spark, sf_dir)
    current = rows.where(F.col("ts") >= ntz(MIDDLE)).drop(*KEEP_SENSORS)
    summary = drift.check_drift(rows.where(F.col("ts") < ntz(MIDDLE)), current)
    return summary.select("drift_detected", F.col("drift_share").cast("double").alias("drift_share"), "total_features", "alert_level")


_DRIFTED = (
    "select sensor, max(n)::bigint as n_reference, max(m)::bigint as n_current, max(abs(f - g)) as d from (select sensor, "
    "sum(r) over w / sum(r) over a as f, sum(c) over w / sum(c) over a as g, sum(r) over a as n, sum(c) over a as m from "
    f"(select sensor, v, count(*) filter (where ts < timestamp '{MIDDLE}') as r, count(*) filter (where ts >= timestamp '{MIDDLE}') as c "
    "from rws group by sensor, v) window w as (partition by sensor order by v), a as (partition by sensor)) group by sensor"
)


@query(
    "drift_report_table",
    sql(
        "select tick, sensor, n_reference, n_current, round(d, 6) as statistic, '2024-01-30' as date from ks, (values (1::bigint), (2::bigint)) t(tick)",
        "e",
        rws=_ROWS,
        ks=_DRIFTED,
    ),
)
def drift_report_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored report of two ticks, the second of them written twice."""
    path = fresh_dir(spark, "reports")
    report, _ = drift.report_and_summary(*halves(spark, sf_dir))
    report = materialized(report, "report")
    summary = drift.drift_summary(report.withColumn("drifted", F.lit(True)), CURRENT)
    for tick in (1, 2, 2):
        drift.append_report(report, summary, ntz("2024-01-30 12:00:00"), tick, path)
    stored = spark.read.parquet(path).select(
        F.col("tick").cast("bigint").alias("tick"), "sensor", "n_reference", "n_current", "statistic", F.col("date").cast("string").alias("date")
    )
    return rounded(stored, "statistic")


# --- feature log -------------------------------------------------------------------------------------


@query(
    "store_compacted",
    sql(
        "select engine_id, cycle, epoch_us(ts) // 1000 as event_time_ms from (select 'ENG-' || unit as engine_id, * from t) "
        "qualify row_number() over (partition by engine_id order by ts desc, cycle desc) = 1",
        "t",
    ),
)
def store_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven writes of the log, compacted after every second; the view reads a snapshot and one batch."""
    online = fresh_dir(spark, "online")
    log = materialized(feature_log(spark, sf_dir), "log")
    for k in range(7):
        part = log.where(F.pmod(F.floor(F.unix_seconds(F.col("written_at").cast("timestamp")) / 90_000), F.lit(7)) == k)
        latest_per_key(part, ["engine_id"], ["written_at", "cycle"]).write.parquet(f"{online}/batch={k}")
        if k % 2:
            featurelog.compact(spark, online, k)
    view = latest_per_key(featurelog.read_log(spark, online), ["engine_id"], ["written_at", "cycle"])
    return view.select("engine_id", "cycle", "event_time_ms")


# --- limited reads -----------------------------------------------------------------------------------


@query(
    "stream_dead_letters",
    sql("select arrival, 3::bigint as least_batches from m where arrival % 10 = 3", "m"),
)
def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken messages from a tail that reads one file at a time: at least three micro-batches."""
    root = fresh_dir(spark, "tail")
    sent = messages(spark, sf_dir)
    broken = F.when(F.col("arrival") % 10 == 3, F.substring("value", 1, 20)).otherwise(F.col("value"))
    sent = sent.withColumn("value", broken)
    sent.repartitionByRange(4, "arrival").write.parquet(f"{root}/in")
    stream = spark.readStream.schema(sent.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")

    def write(batch: DataFrame, batch_id: int) -> None:
        dead_letters(batch).write.mode("overwrite").parquet(f"{root}/dead/batch={batch_id}")

    (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    dead = spark.read.option("basePath", f"{root}/dead").parquet(f"{root}/dead")
    batches = dead.agg(F.least(F.countDistinct("batch"), F.lit(3))).scalar()
    return dead.select("arrival", batches.alias("least_batches"))


# --- alert rule --------------------------------------------------------------------------------------

_WINDOW_COUNTS = (
    "select event_type, w, le, count(*) filter (where latency <= le) as cumulative from (select event_type, "
    "time_bucket(interval 6 hours, ts, timestamp '1970-01-01') as w, value / 1000.0::double as latency from e), "
    f"(select unnest([{', '.join(f'{b}::double' for b in BOUNDS)}, 'infinity'::double]) as le) group by 1, 2, 3"
)


@query(
    "stream_latency_rule",
    sql(
        "select event_type, strftime(min(w), '%Y-%m-%d %H:%M:%S') as since, "
        "strftime(max(w) + interval 6 hours, '%Y-%m-%d %H:%M:%S') as until, "
        "count(*) as windows, round(max(q), 6) as peak from (select *, w - interval 6 hours * row_number() over "
        f"(partition by event_type order by w) as island from qt where q > {RULE_LIMIT}) group by event_type, island having count(*) >= 2",
        "e",
        grw=_WINDOW_COUNTS,
        qt=RULE_QUANTILES,
    ),
)
def stream_latency_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latency rule over three deliveries and a late heartbeat that closes the last windows."""
    root = fresh_dir(spark, "rule")
    rows = events(spark, sf_dir).select("event_type", F.col("ts").cast("timestamp").alias("ts"), (F.col("value") / 1000.0).alias("latency"))
    beat = rows.limit(1).select(
        F.lit("heartbeat").alias("event_type"), F.lit("2100-01-01 00:00:00").cast("timestamp").alias("ts"), F.lit(0.0).alias("latency")
    )
    bounds = ["2024-01-10 03:00:00", "2024-01-20 21:00:00", "2099-01-01 00:00:00"]
    for stream in landed(spark, rows.unionByName(beat), "ts", bounds, "requests"):
        alerts = quantile_alerts(
            stream, "ts", "latency", BOUNDS, ["event_type"], 0.95, RULE_LIMIT, RULE_HOLD, RULE_STEP
        )
        (
            alerts.writeStream.format("parquet")
            .option("path", f"{root}/alerts")
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    found = spark.read.parquet(f"{root}/alerts").withColumns({c: stamp(c) for c in ("since", "until")})
    return rounded(found, "peak")

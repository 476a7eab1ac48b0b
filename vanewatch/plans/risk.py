"""Queries over predictions: scoring, fleet, alerts, feature store, evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vanewatch.functions import scalars
from vanewatch.functions.vectors import sensor_row
from vanewatch.operators import evaluation, fleet, ordering, prepare, quality, scoring, store, windows
from vanewatch.plans.registry import query
from vanewatch.plans.series import BUFFER, RUL, WIDTH, labelled, rounded, sql_histogram
from vanewatch.plans.testviews import AS_OF, events, ntz, predictions, sensor, sql, stamp, telemetry
from vanewatch.session import materialized
from vanewatch.spec import KEEP_SENSORS, WINDOW

# --- scoring -------------------------------------------------------------------------------------

# A linear model whose weights grow with age in the window and with sensor position; they sum to 1.
_TOTAL = sum(r * c for r in range(1, WINDOW + 1) for c in range(1, WIDTH + 1))
WEIGHTS = [r * c / _TOTAL for r in range(1, WINDOW + 1) for c in range(1, WIDTH + 1)]

LIMITS_SQL = "select " + ", ".join(f"min({s}) as lo_{s}, max({s}) as hi_{s}" for s in KEEP_SENSORS) + " from t"
ROW_SUM = (
    "select unit, cycle, "
    + " + ".join(
        f"{i}.0::double * cast(cast(({s} - lo_{s}) / (hi_{s} - lo_{s}) as real) as double)"
        for i, s in enumerate(KEEP_SENSORS, 1)
    )
    + " as x from t, limits"
)
# sum of r * x over the window, r being the place in the window
SCORES = (
    f"select unit, cycle, (sum(cycle * x) over w - (cycle - 30) * sum(x) over w) / {_TOTAL}.0::double as y, "
    "count(*) over w as n from rs "
    "window w as (partition by unit order by cycle rows between 29 preceding and current row)"
)


def scaled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = telemetry(spark, sf_dir)
    params = prepare.minmax_fit(rows, KEEP_SENSORS)
    scaled = prepare.minmax_apply(rows.select("unit", "cycle", *KEEP_SENSORS), params, KEEP_SENSORS)
    return scaled.select("unit", "cycle", sensor_row(KEEP_SENSORS).alias("row"))


@query(
    "linear_score",
    sql("select unit, cycle, round(y, 6) as y from s where n = 30", "t", limits=LIMITS_SQL, rs=ROW_SUM, s=SCORES),
)
def linear_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every sliding window of the fleet."""
    frames = windows.sliding_frames(scaled_rows(spark, sf_dir), "unit", ["cycle"], "row", contiguous=True)
    y = scoring.batch_score("features", WEIGHTS)
    return frames.select("unit", "cycle", F.round(y, 6).alias("y"))


@query(
    "mixed_window_scores",
    sql(
        "select unit, cycle, case when n = 30 then round(y, 6) end as y, n = 30 as has_band from s",
        "t", limits=LIMITS_SQL, rs=ROW_SUM, s=SCORES,
    ),
)
def mixed_window_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows still growing beside full ones: those that are too short have no score and no band."""
    last = Window.partitionBy("unit").orderBy("cycle").rowsBetween(-29, 0)
    frames = scaled_rows(spark, sf_dir).withColumn("features", F.collect_list("row").over(last))
    y = frames.select("unit", "cycle", F.round(scoring.batch_score("features", WEIGHTS), 6).alias("y"))
    return y.withColumn("has_band", scalars.risk_band(1.0 - F.col("y")).isNotNull())


def fleet_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest window of each engine with its score."""
    last = windows.last_frames(scaled_rows(spark, sf_dir), "unit", ["cycle"], "row", WIDTH)
    return last.select(
        F.concat(F.lit("ENG-"), "unit").alias("engine_id"),
        scoring.batch_score("features", WEIGHTS).alias("y"),
    )


def fleet_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.prediction_records(fleet_scores(spark, sf_dir), "y", ntz(AS_OF), "v1")


_BAND = (
    "case when {x} >= 0.8 then 'CRITICAL' when {x} >= 0.6 then 'HIGH' when {x} >= 0.3 then 'MEDIUM' else 'LOW' end"
)
RECORDS = (
    f"select 'ENG-' || unit as engine_id, y, cast(round_even(greatest(y * 125, 0), 0) as integer) as remaining_cycles, "
    "greatest(0, least(1, 1 - greatest(y * 125, 0) / 125)) as risk from s "
    "qualify row_number() over (partition by unit order by cycle desc) = 1"
)
_SCORED = {"limits": LIMITS_SQL, "rs": ROW_SUM, "s": SCORES, "rec": RECORDS}


@query(
    "prediction_record",
    sql(
        "select engine_id, remaining_cycles, round_even(risk, 3) as failure_risk, "
        f"{_BAND.format(x='risk')} as risk_level, cast(1.0 as double) as confidence, 'v1' as model_version from rec",
        "t",
        **_SCORED,
    ),
)
def prediction_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet_predictions(spark, sf_dir).drop("timestamp")


@query(
    "fleet_top_risk",
    sql(
        "select replace(engine_id, 'ENG-', '') as engine, remaining_cycles, "
        f"{_BAND.format(x='risk')} as risk_level from rec order by round_even(risk, 3) desc, engine_id limit 15",
        "t",
        **_SCORED,
    ),
)
def fleet_top_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.top_risk(fleet_predictions(spark, sf_dir))


@query(
    "risk_band",
    sql(
        f"select event_id, round(risk, 6) as risk, {_BAND.format(x='risk')} as band, "
        f"{_BAND.format(x='round_even(risk, 3)')} as band_rounded, "
        "case when rul > 0 and rul <= 30 then 'critical(0-30)' when rul > 30 and rul <= 60 then 'degrading(30-60)' "
        "when rul > 60 and rul <= 90 then 'mid(60-90)' when rul > 90 and rul <= 125 then 'healthy(90-125)' end as bucket, "
        "rul < 30 as critical from (select event_id, value as rul, "
        "greatest(0::double, least(1::double, 1::double - value / 125::double)) as risk from e)",
        "e",
    ),
)
def risk_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    risk = scalars.risk("value")
    return events(spark, sf_dir).select(
        "event_id",
        F.round(risk, 6).alias("risk"),
        scalars.risk_band(risk).alias("band"),
        scalars.risk_band(F.bround(risk, 3)).alias("band_rounded"),
        scalars.rul_bucket("value").alias("bucket"),
        scalars.is_critical("value").alias("critical"),
    )


_MEMBERS = (
    "select user_id as unit, 0.5::double + k / 5000::double as score, "
    "row_number() over (partition by user_id order by ts desc, event_id desc) as rn from e"
)
_ENSEMBLE = (
    "select unit, round(avg(score), 6) as y, round(stddev_pop(score), 6) as y_std, "
    "round_even(greatest(0, least(1, 1 - 10 * stddev_pop(score))), 3) as confidence from members {where} group by unit"
)


@query("ensemble_confidence", sql(_ENSEMBLE.format(where="where rn <= 30"), "e", members=_MEMBERS))
def ensemble_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member scores as one array per unit."""
    rows = events(spark, sf_dir).select(
        F.col("user_id").alias("unit"), "ts", "event_id", (F.lit(0.5) + F.col("k") / 5000.0).alias("score")
    )
    held = windows.last_readings(rows, "unit", ["ts", "event_id"], ["score"])
    scored = scoring.ensemble_summary(held.withColumn("members", F.col("readings.score")), "members")
    return rounded(scored.select("unit", "y", "y_std", "confidence"), "y", "y_std")


@query("ensemble_confidence_rows", sql(_ENSEMBLE.format(where=""), "e", members=_MEMBERS))
def ensemble_confidence_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member scores as rows."""
    rows = events(spark, sf_dir).select(
        F.col("user_id").alias("unit"), (F.lit(0.5) + F.col("k") / 5000.0).alias("score")
    )
    return rounded(scoring.ensemble_summary_rows(rows, ["unit"], "score"), "y", "y_std")


@query(
    "batch_score_errors",
    sql(
        "select 'ENG-' || unit as engine_id, case when n = 60 then cast(round_even(greatest(y * 125, 0), 0) as integer) end "
        "as remaining_cycles, case when n < 60 then 'Expected shape (60, 11), got (' || n || ', 11)' end as error "
        f"from (select unit, least(count(*), 60) as n, "
        f"sum((60 - rn + 1) * x) / {_TOTAL}.0::double / 4 as y from (select *, "
        "row_number() over (partition by unit order by cycle desc) as rn from rs) where rn <= 60 group by unit)",
        "t",
        limits=LIMITS_SQL,
        rs=ROW_SUM,
    ),
)
def batch_score_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 60 rows; engines with fewer get an error, the others a prediction."""
    back = windows.last_readings(scaled_rows(spark, sf_dir), "unit", ["cycle"], ["row"], 60)
    requests = back.select(
        F.concat(F.lit("ENG-"), "unit").alias("engine_id"), F.col("readings.row").alias("sensor_data")
    )
    weights = [r * c / _TOTAL / 4 for r in range(1, 61) for c in range(1, WIDTH + 1)]
    scored = scoring.score_or_error(requests, weights, ntz(AS_OF), "v1", WIDTH, window=60)
    return scored.select("engine_id", "remaining_cycles", "error")


_BUFFER_TOTAL = sum(r * c for r in range(1, BUFFER + 1) for c in range(1, WIDTH + 1))
RAW_LIMITS = {s: (0.0, 500.0 * int(s[1:])) for s in KEEP_SENSORS}
_RAW_ROW = " + ".join(
    f"{i}.0::double * cast(cast({s} as real)::double / {500.0 * int(s[1:])}::double as real)::double"
    for i, s in enumerate(KEEP_SENSORS, 1)
)


@query(
    "raw_window_score",
    sql(
        f"select unit, count(*) as readings, case when count(*) < {BUFFER} then "
        f"'Expected {BUFFER} readings, got ' || count(*) when bool_or(not full_row) then 'Missing required sensor keys: s21' end as error, "
        f"case when count(*) = {BUFFER} and bool_and(full_row) then round(sum(({BUFFER + 1} - rn) * x) / {_BUFFER_TOTAL}.0::double, 6) end as y "
        "from (select user_id as unit, full_row, x, row_number() over (partition by user_id order by event_id desc) as rn from "
        f"(select user_id, event_id, k > 0 as full_row, {_RAW_ROW} as x from (select *, "
        + ", ".join(f"value + {s[1:]}.0::double * k as {s}" for s in KEEP_SENSORS)
        + f" from e))) where rn <= {BUFFER} group by unit",
        "e",
    ),
)
def raw_window_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last pushed raw readings: check keys, scale, score; sensor s21 is absent for k = 0."""
    full = F.create_map(*[x for s in KEEP_SENSORS for x in (F.lit(s), sensor(s))])
    reading = F.when(F.col("k") > 0, full).otherwise(F.map_filter(full, lambda n, _: n != "s21"))
    rows = events(spark, sf_dir).select(F.col("user_id").alias("unit"), "event_id", reading.alias("reading"))
    held = windows.last_readings(rows, "unit", ["event_id"], ["reading"], BUFFER)
    checked = scoring.raw_windows(held.withColumn("readings", F.col("readings.reading")), RAW_LIMITS, BUFFER)
    weights = [r * c / _BUFFER_TOTAL for r in range(1, BUFFER + 1) for c in range(1, WIDTH + 1)]
    y = scoring.linear_score(F.flatten("sensor_data"), weights)
    return checked.select(
        "unit",
        F.col("buffered").alias("readings"),
        "error",
        F.when(F.col("error").isNull(), F.round(y, 6)).alias("y"),
    )


@query(
    "push_key_check",
    sql(
        "select user_id as unit, count(*) filter (where k > 2) as accepted, count(*) filter (where k <= 2) as rejected "
        "from e group by user_id",
        "e",
    ),
)
def push_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = F.create_map(F.lit("s2"), F.col("value"), F.lit("s21"), F.col("k"))
    reading = F.when(F.col("k") > 2, full).otherwise(F.map_filter(full, lambda n, _: n != "s21"))
    log = events(spark, sf_dir).select(F.col("user_id").alias("unit"), reading.alias("reading"))
    ok = quality.accepted_readings(log, ["s2", "s21"]).select("unit", F.lit(1).alias("a"), F.lit(0).alias("r"))
    bad = quality.rejected_readings(log, ["s2", "s21"]).select("unit", F.lit(0).alias("a"), F.lit(1).alias("r"))
    return ok.unionByName(bad).groupBy("unit").agg(F.sum("a").alias("accepted"), F.sum("r").alias("rejected"))


# --- fleet ---------------------------------------------------------------------------------------


def latest_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.latest_per_key(predictions(spark, sf_dir), ["engine_id"], ["ts", "event_id"])


@query(
    "fleet_kpi",
    sql(
        "select count(*) as active_engines, count(*) filter (where risk_level = 'CRITICAL') as critical_engines, "
        "count(*) filter (where risk_level = 'HIGH') as high_engines, "
        "cast(coalesce(round(avg(remaining_cycles)), 0) as bigint) as avg_rul from latest",
        "latest",
    ),
)
def fleet_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.fleet_kpi(latest_predictions(spark, sf_dir))


@query(
    "risk_distribution",
    sql(
        "select l as risk_level, count(engine_id) as engines from (select unnest(['LOW', 'MEDIUM', 'HIGH', 'CRITICAL']) as l) "
        "left join latest on risk_level = l group by l",
        "latest",
    ),
)
def risk_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.risk_distribution(latest_predictions(spark, sf_dir))


_SHORT = "engine_id, remaining_cycles, failure_risk, risk_level"


def _short(df: DataFrame) -> DataFrame:
    return df.select(
        "engine_id", F.col("remaining_cycles").cast("bigint").alias("remaining_cycles"), "failure_risk", "risk_level"
    )


@query("predictions_by_risk", sql(f"select {_SHORT} from latest order by failure_risk desc, engine_id", "latest"))
def predictions_by_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _short(fleet.by_risk(latest_predictions(spark, sf_dir)))


@query(
    "top_risk",
    sql(
        "select replace(engine_id, 'ENG-', '') as engine, remaining_cycles, risk_level from latest "
        "order by failure_risk desc, engine_id limit 15",
        "latest",
    ),
)
def top_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fleet.top_risk(latest_predictions(spark, sf_dir))
    return rows.withColumn("remaining_cycles", F.col("remaining_cycles").cast("bigint"))


@query(
    "engine_search",
    sql(
        f"select {_SHORT} from latest where lower(engine_id) like '%g-1%' and risk_level = 'CRITICAL'",
        "latest",
    ),
)
def engine_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _short(fleet.search(latest_predictions(spark, sf_dir), "G-1", "CRITICAL"))


@query(
    "alerts_min_level",
    sql(f"select {_SHORT} from latest where risk_level in ('MEDIUM', 'HIGH', 'CRITICAL')", "latest"),
)
def alerts_min_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _short(fleet.alerts(latest_predictions(spark, sf_dir), "medium"))


@query(
    "alerts_unknown_level",
    sql(f"select {_SHORT} from latest where risk_level in ('HIGH', 'CRITICAL')", "latest"),
)
def alerts_unknown_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _short(fleet.alerts(latest_predictions(spark, sf_dir), "severe"))


@query(
    "average_cycle",
    sql(
        "select count(*) as engines, cast(coalesce(round(avg(n)), 0) as bigint) as avg_cycle from "
        "(select user_id, count(*) as n from e group by user_id)",
        "e",
    ),
)
def average_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.average_cycle(events(spark, sf_dir).groupBy("user_id").agg(F.count(F.lit(1)).alias("cycle")))


@query("engine_ids", sql("select distinct 'ENG-' || user_id as engine_id from e order by 1", "e"))
def engine_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions(spark, sf_dir).select("engine_id").distinct().orderBy("engine_id")


_ALERT_LOG = (
    "select *, event_type = 'signup' as is_ack, "
    "event_type <> 'signup' and risk_level in ('HIGH', 'CRITICAL') as is_alert from p"
)
_EPOCHS = (
    "select *, coalesce(sum(case when is_ack then 1 else 0 end) over (partition by engine_id order by ts, event_id "
    "rows between unbounded preceding and 1 preceding), 0) as epoch, "
    "sum(case when is_ack then 1 else 0 end) over (partition by engine_id) as acks from log"
)
_OPENED = (
    "select engine_id, cast(epoch as bigint) as epoch, event_id, ts, risk_level, failure_risk, epoch < acks as acknowledged "
    "from ep where is_alert qualify row_number() over (partition by engine_id, epoch order by ts, event_id) = 1"
)
_ALERT_SQL = {"log": _ALERT_LOG, "ep": _EPOCHS, "op": _OPENED}


def alert_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = predictions(spark, sf_dir).withColumn("is_ack", F.col("event_type") == "signup")
    risky = F.col("risk_level").isin("HIGH", "CRITICAL")
    return rows.withColumn("is_alert", ~F.col("is_ack") & risky).select(
        "engine_id", "ts", "event_id", "risk_level", "failure_risk", "remaining_cycles", "is_alert", "is_ack"
    )


def opened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.deduplicated_alerts(materialized(alert_log(spark, sf_dir), "alerts"), ["ts", "event_id"])


@query(
    "alert_dedupe",
    sql("select engine_id, epoch, event_id, risk_level, failure_risk, acknowledged from op", "p", **_ALERT_SQL),
)
def alert_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return opened(spark, sf_dir).select(
        "engine_id", "epoch", "event_id", "risk_level", "failure_risk", "acknowledged"
    )


def _with_id(df: DataFrame) -> DataFrame:
    return df.withColumn("id", fleet.alert_id(F.col("engine_id"), stamp("ts"))).withColumnRenamed("ts", "timestamp")


@query(
    "newest_alerts",
    sql(
        "select engine_id || '-' || strftime(ts, '%Y-%m-%d %H:%M:%S') as id, engine_id, risk_level, acknowledged "
        "from op order by ts desc limit 50",
        "p",
        **_ALERT_SQL,
    ),
)
def newest_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.newest(_with_id(opened(spark, sf_dir)), 50).select("id", "engine_id", "risk_level", "acknowledged")


@query(
    "open_alerts",
    sql(
        "select engine_id || '-' || strftime(ts, '%Y-%m-%d %H:%M:%S') as id, engine_id, risk_level "
        "from op where not acknowledged order by ts desc limit 8",
        "p",
        **_ALERT_SQL,
    ),
)
def open_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.open_alerts(_with_id(opened(spark, sf_dir))).select("id", "engine_id", "risk_level")


# --- feature store -------------------------------------------------------------------------------

TTL = 12 * 3600
_LIVE = (
    f"select * from t2 where written_at > timestamp '{AS_OF}' - interval {TTL} second and written_at <= timestamp '{AS_OF}'"
)
_LOG = (
    "select 'ENG-' || user_id as engine_id, ts as written_at, event_id as arrival, k, value, event_type, "
    "row_number() over (partition by user_id order by ts, event_id) as cycle, epoch_us(ts) // 1000 as event_time_ms from e"
)
_STORE = {"t2": _LOG, "live": _LIVE}
_LATEST = "select * from live qualify row_number() over (partition by engine_id order by written_at desc, arrival desc) = 1"


def feature_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One write per event; the stored vector is too short for small k."""
    rows = telemetry(spark, sf_dir)
    vector = sensor_row(KEEP_SENSORS)
    return rows.select(
        F.concat(F.lit("ENG-"), "unit").alias("engine_id"),
        F.col("ts").alias("written_at"),
        F.col("event_id").alias("arrival"),
        "cycle",
        scalars.epoch_ms("ts").alias("event_time_ms"),
        F.when(F.col("os2") < 0.01, F.slice(vector, 1, 5)).otherwise(vector).alias("features"),
    )


def store_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.latest_features(feature_log(spark, sf_dir), ntz(AS_OF), ttl=TTL)


def writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and time of each write to the feature log."""
    return events(spark, sf_dir).select(
        F.concat(F.lit("ENG-"), "user_id").alias("engine_id"), F.col("ts").alias("written_at")
    )


@query("store_active", sql("select distinct engine_id from live", "e", **_STORE))
def store_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.active_engines(writes(spark, sf_dir), ntz(AS_OF), ttl=TTL)


@query(
    "telemetry_snapshot",
    sql("select engine_id, cycle, event_time_ms, cast(30 as bigint) as window_size from l", "e", **_STORE, l=_LATEST),
)
def telemetry_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.telemetry_snapshot(store_view(spark, sf_dir))


@query(
    "telemetry_head",
    sql("select engine_id, cycle, event_time_ms from l order by engine_id limit 20", "e", **_STORE, l=_LATEST),
)
def telemetry_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = store.telemetry_head(store.telemetry_snapshot(store_view(spark, sf_dir)))
    return rows.select("engine_id", "cycle", "event_time_ms")


@query("stored_vector_check", sql("select engine_id, cycle from l where k >= 10", "e", **_STORE, l=_LATEST))
def stored_vector_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.usable_features(store_view(spark, sf_dir), 1, WIDTH).select("engine_id", "cycle")


@query(
    "features_with_meta",
    sql(
        "select l.engine_id, coalesce(m.cycle, 0) as cycle, coalesce(m.event_time_ms, 0) as event_time_ms, "
        "cast(case when m.cycle is null then 30 else 11 end as bigint) as window_size from l left join "
        "(select * from l where k >= 50) m using (engine_id)",
        "e",
        **_STORE,
        l=_LATEST,
    ),
)
def features_with_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meta data is missing for small k."""
    view = store_view(spark, sf_dir)
    second = F.element_at("features", 2) - F.element_at("features", 1)  # (3 - 2) k
    meta = view.where(F.round(second.cast("double")) >= 50).select(
        "engine_id", "cycle", "event_time_ms", F.lit(11).alias("window_size")
    )
    joined = store.with_meta(view.select("engine_id"), meta)
    return joined.select(
        "engine_id", "cycle", "event_time_ms", F.col("window_size").cast("bigint").alias("window_size")
    )


@query(
    "skip_missing_lookup",
    sql(
        "select engine_id, cycle from l where engine_id in (select engine_id from t2 where event_type = 'purchase' and value > 100)",
        "e",
        **_STORE,
        l=_LATEST,
    ),
)
def skip_missing_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = predictions(spark, sf_dir).where((F.col("event_type") == "purchase") & (F.col("value") > 100))
    return store.lookup(wanted, store_view(spark, sf_dir)).select("engine_id", "cycle")


_BUFFER = f"select engine_id, least(count(*), {BUFFER}) as buffered from t2 group by 1"
_LAST_HIGH = (
    "select engine_id, risk_level from p where risk_level in ('HIGH', 'CRITICAL') "
    "qualify row_number() over (partition by engine_id order by ts desc, event_id desc) = 1"
)


def push_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.buffer_sizes(predictions(spark, sf_dir), "engine_id", BUFFER)


@query(
    "engine_status",
    sql(
        "select engine_id, case when s.engine_id is not null then 'redis_stream' else 'push_buffer' end as source, "
        f"s.engine_id is not null or coalesce(buffered, 0) >= {BUFFER} as ready, h.risk_level as last_level "
        "from (select distinct engine_id from live) s full join b using (engine_id) left join h using (engine_id)",
        "p",
        **_STORE,
        b=_BUFFER,
        h=_LAST_HIGH,
    ),
)
def engine_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    risky = predictions(spark, sf_dir).where(F.col("risk_level").isin("HIGH", "CRITICAL"))
    last = ordering.latest_per_key(risky, ["engine_id"], ["ts", "event_id"], ["risk_level"])
    active = store.active_engines(writes(spark, sf_dir), ntz(AS_OF), ttl=TTL)
    status = store.engine_status(active, push_buffer(spark, sf_dir), last, window=BUFFER)
    return status.select("engine_id", "source", "ready", F.col("last_prediction.risk_level").alias("last_level"))


@query("engine_union", sql("select engine_id from live union select engine_id from b", "e", **_STORE, b=_BUFFER))
def engine_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    active = store.active_engines(writes(spark, sf_dir), ntz(AS_OF), ttl=TTL)
    return store.known_engines(active, push_buffer(spark, sf_dir))


# --- evaluation ----------------------------------------------------------------------------------

_EVAL = (
    "select unit, cycle, true_rul, pred_rul, pred_rul - true_rul as error, abs(pred_rul - true_rul) as abs_error, "
    "true_rul < 30 as critical_true, pred_rul < 30 as critical_pred from (select unit, cycle, "
    "least(125::double, rul * 2.5::double) as true_rul, "
    "greatest(0::double, least(125::double, least(125::double, rul * 2.5::double) + (os2 * 1000::double - 49.5::double) / 2::double)) "
    "as pred_rul from r)"
)
_COUNTS = (
    "select count(*) filter (where not critical_true and not critical_pred)::double as tn, "
    "count(*) filter (where not critical_true and critical_pred)::double as fp, "
    "count(*) filter (where critical_true and not critical_pred)::double as fn, "
    "count(*) filter (where critical_true and critical_pred)::double as tp from ev"
)
_REPORT = (
    "select 'Non-Critical' as label, tn / (tn + fn) as precision, tn / (tn + fp) as recall, "
    "2 * tn / (2 * tn + fn + fp) as f1_score, tn + fp as support from c union all "
    "select 'Critical', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fn + fp), tp + fn from c"
)
_EVALUATED = {"r": RUL, "ev": _EVAL, "c": _COUNTS, "cl": _REPORT}
_METRICS = (
    "select sqrt(avg(error * error)) as rmse, sum(case when error < 0 then exp(-error / 13) - 1 else exp(error / 10) - 1 end) "
    "as penalty_score, any_value((select precision from cl where label = 'Critical')) as precision_critical, "
    "any_value((select recall from cl where label = 'Critical')) as recall_critical, "
    "any_value((select f1_score from cl where label = 'Critical')) as f1_critical, "
    "any_value((select (tp + tn) / (tp + tn + fp + fn) from c)) as accuracy, "
    "any_value((select sum(f1_score * support) / sum(support) from cl)) as f1_weighted from ev"
)
_METRIC_NAMES = (
    "rmse", "penalty_score", "precision_critical", "recall_critical", "f1_critical", "accuracy", "f1_weighted"
)


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    true = scalars.clip_between(F.col("rul") * 2.5, 0, 125)
    pred = scalars.clip_between(true + (F.col("os2") * 1000.0 - 49.5) / 2.0, 0, 125)
    rows = labelled(spark, sf_dir).select("unit", "cycle", true.alias("t"), pred.alias("p"))
    return evaluation.evaluation_rows(rows, "t", "p", ["unit", "cycle"])


@query(
    "evaluation_rows",
    sql(
        "select unit, cycle, round(true_rul, 6) as true_rul, round(pred_rul, 6) as pred_rul, round(error, 6) as error, "
        "round(abs_error, 6) as abs_error, critical_true, critical_pred from ev",
        "t",
        **_EVALUATED,
    ),
)
def evaluation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(results(spark, sf_dir), "true_rul", "pred_rul", "error", "abs_error")


@query("rmse", sql("select round(sqrt(avg(error * error)), 6) as rmse from ev", "t", **_EVALUATED))
def rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results(spark, sf_dir).agg(F.round(evaluation.rmse(), 6).alias("rmse"))


@query(
    "penalty_score",
    sql(
        "select round(sum(case when error < 0 then exp(-error / 13) - 1 else exp(error / 10) - 1 end), 4) as penalty_score from ev",
        "t",
        **_EVALUATED,
    ),
)
def penalty_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results(spark, sf_dir).agg(F.round(evaluation.penalty_score(), 4).alias("penalty_score"))


@query(
    "confusion",
    sql(
        "select a as actual, b as predicted, count(critical_true) as n from (select unnest([true, false]) as a) "
        "cross join (select unnest([true, false]) as b) left join ev on critical_true = a and critical_pred = b group by a, b",
        "t",
        **_EVALUATED,
    ),
)
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.confusion(results(spark, sf_dir))


@query(
    "classification_report",
    sql(
        "select label, round(precision, 6) as precision, round(recall, 6) as recall, round(f1_score, 6) as f1_score, "
        "round(support, 6) as support from (select * from cl union all "
        "select 'accuracy', (tp + tn) / n, (tp + tn) / n, (tp + tn) / n, n from (select *, tp + tn + fp + fn as n from c) union all "
        "select 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) from cl union all "
        "select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), "
        "sum(f1_score * support) / sum(support), sum(support) from cl)",
        "t",
        **_EVALUATED,
    ),
)
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = evaluation.classification_report(results(spark, sf_dir))
    return rounded(report, "precision", "recall", "f1_score", "support")


@query(
    "label_classification",
    sql(
        "select count(*) filter (where quality = 0 and toxic = 0) as tn, count(*) filter (where quality = 0 and toxic = 1) as fp, "
        "count(*) filter (where quality = 1 and toxic = 0) as fn, count(*) filter (where quality = 1 and toxic = 1) as tp from labels"
    ),
)
def label_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vanewatch.plans.testviews import table

    pairs = table(spark, sf_dir, "labels").select((F.col("quality") == 1).alias("t"), (F.col("toxic") == 1).alias("p"))
    return pairs.agg(*evaluation.confusion_columns("t", "p"))


@query(
    "eval_summary",
    sql(
        "select round_even(rmse, 2) as rmse, round_even(penalty_score, 1) as penalty_score, "
        + ", ".join(f"round_even({m}, 3) as {m}" for m in _METRIC_NAMES[2:])
        + " from mt",
        "t",
        **_EVALUATED,
        mt=_METRICS,
    ),
)
def eval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.summary(evaluation.metrics(results(spark, sf_dir)))


_TARGETS = {
    "rmse": ("<", 20), "penalty_score": ("<", 2000), "precision_critical": (">", 0.8), "recall_critical": (">", 0.75),
    "f1_critical": (">", 0.8), "accuracy": (">", 0.8), "f1_weighted": (">", 0.8),
}


@query(
    "quality_scoreboard",
    sql(
        " union all ".join(
            f"select '{m}' as metric, round({m}, 4) as value, '{op}' as comparison, {x}::double as target, {m} {op} {x} as ok from mt"
            for m, (op, x) in _TARGETS.items()
        ),
        "t",
        **_EVALUATED,
        mt=_METRICS,
    ),
)
def quality_scoreboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    board = evaluation.scoreboard(evaluation.metrics(results(spark, sf_dir)))
    return board.withColumn("value", F.round("value", 4))


@query(
    "promotion_gate",
    sql(
        "select round(rmse, 6) as rmse, round(penalty_score, 4) as penalty_score, rmse <= 70 and penalty_score <= 10000 as promote from mt",
        "t",
        **_EVALUATED,
        mt=_METRICS,
    ),
)
def promotion_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = evaluation.gate(evaluation.metrics(results(spark, sf_dir)))
    return one.withColumns({"rmse": F.round("rmse", 6), "penalty_score": F.round("penalty_score", 4)})


@query(
    "error_by_bucket",
    sql(
        "select case when true_rul <= 30 then 'critical(0-30)' when true_rul <= 60 then 'degrading(30-60)' "
        "when true_rul <= 90 then 'mid(60-90)' else 'healthy(90-125)' end as bucket, round_even(avg(abs_error), 2) as mean, "
        "count(*) as count from ev where true_rul > 0 group by 1",
        "t",
        **_EVALUATED,
    ),
)
def error_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.error_by_bucket(results(spark, sf_dir))


@query("error_histogram", sql(sql_histogram("ev", "error", 30), "t", **_EVALUATED))
def error_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(prepare.histogram(results(spark, sf_dir), "error", 30), "bin_start", "bin_end")

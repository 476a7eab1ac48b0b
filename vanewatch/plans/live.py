"""Registered queries that run as streams, and those that train a model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewatch.functions.vectors import sensor_row
from vanewatch.operators import prepare, scoring, training, windows
from vanewatch.operators.fleet import at_least
from vanewatch.plans.registry import query
from vanewatch.plans.risk import _ALERT_SQL, alert_log, scaled_rows
from vanewatch.plans.series import (
    ACCEPTED,
    CLAMPED,
    FRAME_FACTS,
    LIMITS,
    WIDTH,
    flat_facts,
    labelled,
    rounded,
)
from vanewatch.plans.testviews import messages, sql, telemetry
from vanewatch.session import fresh_dir, materialized
from vanewatch.spec import KEEP_SENSORS, ROWS_PER_FILE
from vanewatch.streaming.alerts import opened_alerts
from vanewatch.streaming.jobs import offline_table, online_view, score_fleet, store_features
from vanewatch.streaming.rolling import normalized_events, rolling_features

STREAM_WINDOW = 10
AS_OF_MS = 1_706_745_600_000  # 2024-02-01 00:00:00 UTC
STREAM_TTL = 3 * 86_400


def _in_two_steps(
    spark: SparkSession, rows: DataFrame, run: Callable[[DataFrame], None], name: str
) -> None:
    """Land the first half of the arrivals, run the stream, land the rest, run it again.

    The second run continues from the state and offsets of the first.
    """
    stored = materialized(rows, f"{name}-source")
    landing = fresh_dir(spark, name)
    middle = F.col("arrival") <= stored.agg(F.avg("arrival")).scalar()
    for part in (stored.where(middle), stored.where(~middle)):
        part.write.mode("append").parquet(landing)
        run(spark.readStream.schema(stored.schema).parquet(landing))


def run_feature_stream(spark: SparkSession, sf_dir: str, root: str) -> None:
    sent = messages(spark, sf_dir)

    def run(stream: DataFrame) -> None:
        features = rolling_features(normalized_events(stream, LIMITS), WIDTH, STREAM_WINDOW)
        store_features(
            features,
            f"{root}/online",
            f"{root}/offline",
            f"{root}/checkpoint",
            every=None,
            written_at=F.timestamp_millis("event_time"),
            files_per_hour=1,  # a replay of many days
        ).awaitTermination()

    _in_two_steps(spark, sent, run, "messages")


@query("stream_features", sql(FRAME_FACTS.format(n=STREAM_WINDOW), "m", c=CLAMPED, a=ACCEPTED))
def stream_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offline table written by the stream: every window, each exactly once."""
    root = fresh_dir(spark, "features")
    run_feature_stream(spark, sf_dir, root)
    table = offline_table(spark, f"{root}/offline")
    return table.select(
        "engine_id", F.col("cycle").cast("bigint").alias("cycle"), "event_time", *flat_facts("features", STREAM_WINDOW)
    )


_MEANS = (
    "select engine_id, cycle, event_time_ms, sum(list_sum(list_transform(vec, lambda x: x::double))) over w / 110.0::double as y, "
    "count(*) over w as n from a window w as (partition by engine_id order by arrival rows between 9 preceding and current row)"
)
_LIVE = (
    f"select engine_id, cast(round_even(greatest(y * 125, 0), 0) as integer) as remaining_cycles, "
    "greatest(0, least(1, 1 - y)) as risk from means where n = 10 "
    f"and event_time_ms > {AS_OF_MS} - {STREAM_TTL} * 1000 "
    "qualify row_number() over (partition by engine_id order by cycle desc) = 1"
)


@query(
    "stream_fleet_alerts",
    sql(
        "select engine_id, remaining_cycles, case when risk >= 0.8 then 'CRITICAL' when risk >= 0.6 then 'HIGH' "
        "when risk >= 0.3 then 'MEDIUM' else 'LOW' end as risk_level from live where risk >= 0.3",
        "m",
        c=CLAMPED,
        a=ACCEPTED,
        means=_MEANS,
        live=_LIVE,
    ),
)
def stream_fleet_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature stream into the online store, then one scoring tick over the live engines."""
    root = fresh_dir(spark, "fleet")
    run_feature_stream(spark, sf_dir, root)
    size = STREAM_WINDOW * WIDTH

    def score(view: DataFrame) -> DataFrame:
        y = scoring.linear_score("features", F.array_repeat(F.lit(1.0 / size), size))
        return scoring.prediction_records(view.withColumn("y", y), "y", F.current_timestamp(), "v1")

    ticks = spark.readStream.schema("engine_id STRING").parquet(f"{root}/online/batch=0")
    score_fleet(
        ticks,
        lambda: online_view(spark, f"{root}/online", F.timestamp_millis(F.lit(AS_OF_MS)), STREAM_TTL),
        score,
        f"{root}/predictions",
        f"{root}/alerts",
        f"{root}/ticks",
        every=None,
        min_level="MEDIUM",
    ).awaitTermination()
    alerts = spark.read.option("basePath", f"{root}/alerts").parquet(f"{root}/alerts")
    return at_least(alerts, "MEDIUM").select("engine_id", "remaining_cycles", "risk_level")


@query(
    "stream_alert_dedupe",
    sql("select engine_id, event_id as arrival, risk_level, failure_risk from op", "p", **_ALERT_SQL),
)
def stream_alert_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_dir(spark, "alerts")
    log = alert_log(spark, sf_dir).select(
        "engine_id", F.col("event_id").alias("arrival"), "risk_level", "failure_risk", "is_alert", "is_ack"
    )

    def run(stream: DataFrame) -> None:
        (
            opened_alerts(stream)
            .writeStream.format("parquet")
            .option("path", f"{root}/opened")
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )

    _in_two_steps(spark, log, run, "alert-log")
    return spark.read.parquet(f"{root}/opened")


# --- training ------------------------------------------------------------------------------------


def gold(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training and validation windows, written once because the solver reads them many times."""
    rows = labelled(spark, sf_dir)
    params = prepare.minmax_fit(telemetry(spark, sf_dir), KEEP_SENSORS)
    scaled = prepare.minmax_apply(rows.select("unit", "cycle", "rul", *KEEP_SENSORS), params, KEEP_SENSORS)
    rows = scaled.select("unit", "cycle", "rul", sensor_row(KEEP_SENSORS).alias("row"))
    frames = windows.sliding_frames(rows, "unit", ["cycle"], "row", contiguous=True)
    stored = materialized(frames.drop("row"), "gold", rows_per_file=ROWS_PER_FILE)
    return prepare.train_validation(stored)


@query("rul_regressor_metrics")
def rul_regressor_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted linear model on all training windows, judged on the validation units."""
    train, validation = gold(spark, sf_dir)
    model = training.fit_linear(training.training_rows(train, "features", "rul", 60.0))
    return rounded(training.validation_rmse(model, training.training_rows(validation, "features", "rul", 60.0)), "val_rmse")


@query("forest_confidence")
def forest_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forest on the training windows; its trees give each engine's newest window a confidence."""
    train, _ = gold(spark, sf_dir)
    model = training.fit_forest(training.training_rows(train, "features", "rul", 60.0), depth=4)
    last = windows.last_frames(scaled_rows(spark, sf_dir), "unit", ["cycle"], "row", WIDTH)
    as_doubles = F.flatten("features").cast("array<double>")
    scored = training.with_member_scores(last.withColumn("vector", array_to_vector(as_doubles)), model)
    summary = scoring.ensemble_summary(scored, "members")
    return rounded(summary.select("unit", "y", "y_std", "confidence"), "y", "y_std")

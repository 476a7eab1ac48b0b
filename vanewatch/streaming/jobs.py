"""Streaming queries: features to both stores, and periodic scoring of the fleet.

Every sink writes the folder of its own micro-batch and overwrites it when the batch is replayed,
so a restart from the checkpoint neither loses nor repeats rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vanewatch.operators.drift import added_up, drift_summary, ks_from_counts, value_counts
from vanewatch.operators.fleet import at_least
from vanewatch.operators.ordering import latest_per_key
from vanewatch.operators.store import latest_features
from vanewatch.session import materialized, scratch
from vanewatch.sources.featurelog import compact, read_log
from vanewatch.spec import DRIFT_MIN_ROWS, KEEP_SENSORS, TTL_SECONDS
from vanewatch.streaming.rolling import FEATURE_SCHEMA

CHECKPOINT_SECONDS = 60


def _started(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, every: str | None
) -> StreamingQuery:
    """``every`` None processes what is there and stops; else one micro-batch per interval."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def store_features(
    features: DataFrame,
    online: str,
    offline: str | None,
    checkpoint: str,
    every: str | None = f"{CHECKPOINT_SECONDS} seconds",
    written_at: Column | None = None,
    files_per_hour: int = 8,
    compact_every: int = 100,
) -> StreamingQuery:
    """Latest vector per engine to the online log, then all vectors to the offline table by hour.

    ``files_per_hour`` tasks write the rows of one hour in one micro-batch, whichever engines
    they come from. Every ``compact_every`` micro-batches the online log is compacted (0: never).
    """
    event_time = F.timestamp_millis("event_time")

    def write(batch: DataFrame, batch_id: int) -> None:
        stamped = batch.withColumn("written_at", F.current_timestamp() if written_at is None else written_at)
        stamped = stamped.persist()
        try:
            newest = latest_per_key(stamped, ["engine_id"], ["cycle"])
            newest.write.mode("overwrite").parquet(f"{online}/batch={batch_id}")
            if offline:
                (
                    stamped.drop("written_at")
                    .withColumn("date", F.date_format(event_time, "yyyy-MM-dd"))
                    .withColumn("hour", F.date_format(event_time, "HH"))
                    .withColumn("batch", F.lit(batch_id).cast("bigint"))
                    .repartition("date", "hour", F.pmod(F.hash("engine_id", "cycle"), F.lit(files_per_hour)))
                    .write.mode("overwrite")
                    # a replay replaces the folders of its own batch, below the hours
                    .option("partitionOverwriteMode", "dynamic")
                    .partitionBy("date", "hour", "batch")
                    .parquet(offline)
                )
            if compact_every and (batch_id + 1) % compact_every == 0:
                compact(batch.sparkSession, online, batch_id)
        finally:
            stamped.unpersist()

    return _started(features, write, checkpoint, every)


def online_log(spark: SparkSession, online: str) -> DataFrame:
    """The feature log: the current snapshot and the micro-batches after it; ``batch`` orders writes of the same time."""
    return read_log(spark, online)


def offline_table(spark: SparkSession, offline: str) -> DataFrame:
    """All stored feature vectors; filters on date, hour and batch choose the folders that are read."""
    return spark.read.schema(f"{FEATURE_SCHEMA}, date STRING, hour STRING, batch BIGINT").parquet(offline)


def online_view(spark: SparkSession, online: str, as_of: Column, ttl: int = TTL_SECONDS) -> DataFrame:
    """Live engines with their newest vector, as of a time not before the last compaction's newest write."""
    return latest_features(online_log(spark, online), as_of, order=("written_at", "cycle"), ttl=ttl)


def score_fleet(
    ticks: DataFrame,
    view: Callable[[], DataFrame],
    score: Callable[[DataFrame], DataFrame],
    predictions: str,
    alerts: str,
    checkpoint: str,
    every: str | None = "5 seconds",
    min_level: str = "HIGH",
) -> StreamingQuery:
    """At each micro-batch of ``ticks`` score all live engines; write predictions and alerts."""

    def write(batch: DataFrame, batch_id: int) -> None:
        scored = score(view()).persist()
        try:
            scored.write.mode("overwrite").parquet(f"{predictions}/batch={batch_id}")
            at_least(scored, min_level).write.mode("overwrite").parquet(f"{alerts}/batch={batch_id}")
        finally:
            scored.unpersist()

    return _started(ticks, write, checkpoint, every)


def monitor_drift(
    readings: DataFrame,
    reference: DataFrame,
    root: str,
    checkpoint: str,
    days: int = 7,
    sensors: Sequence[str] = KEEP_SENSORS,
    min_rows: int = DRIFT_MIN_ROWS,
    time: str = "ts",
    every: str | None = "1 hour",
) -> StreamingQuery:
    """At each micro-batch check the last ``days`` days up to the newest reading, however few are new.

    A reading is counted once, in the micro-batch that brings it: counts per day, sensor and value go to
    ``root/days``. The counts of the current range (``root/range``) are those of the tick before, with the
    new readings inside the range added and the days that have left it taken away. ``reference`` has the
    value counts of the reference, made once. ``root/report`` has a row per tick and sensor, and
    ``root/summary`` one per tick, none where the whole range holds too few readings. A tick writes
    folders of its own number, so a replay changes nothing; its other tables go when it ends.
    """
    spark = readings.sparkSession
    counts = "sensor STRING, value DOUBLE, n BIGINT"

    def read(name: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).option("basePath", f"{root}/{name}").parquet(f"{root}/{name}")

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch(spark):
            by_day = value_counts(batch.withColumn("day", F.to_date(time)), sensors, ["day"])
            by_day.write.mode("overwrite").partitionBy("day").parquet(f"{root}/days/batch={batch_id}")
            stored = read("days", f"{counts}, batch BIGINT, day DATE").where(F.col("batch") <= batch_id)
            earlier = F.col("batch") < batch_id
            end, end_before = stored.agg(F.max("day"), F.max(F.when(earlier, F.col("day")))).first()

            def inside(last) -> Column:
                return (F.col("day") <= F.lit(last)) & (F.col("day") > F.date_sub(F.lit(last), days))

            parts = [(1, stored.where(~earlier & inside(end)))]
            if batch_id:
                parts.append((1, read("range", f"{counts}, batch BIGINT").where(F.col("batch") == batch_id - 1)))
            if end_before:
                parts.append((-1, stored.where(earlier & inside(end_before) & ~inside(end))))
            added_up(*parts).write.mode("overwrite").parquet(f"{root}/range/batch={batch_id}")
            current = read("range", f"{counts}, batch BIGINT").where(F.col("batch") == batch_id).drop("batch")
            report = materialized(ks_from_counts(reference, current), "report")
            report.write.mode("overwrite").parquet(f"{root}/report/batch={batch_id}")
            summary = drift_summary(report, sensors)
            enough = F.coalesce(current.groupBy("sensor").agg(F.sum("n").alias("n")).agg(F.max("n")).scalar(), F.lit(0))
            summary.where(enough >= min_rows).write.mode("overwrite").parquet(f"{root}/summary/batch={batch_id}")

    return _started(readings, write, checkpoint, every)

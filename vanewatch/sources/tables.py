"""Parquet tables between stages, parameter files, logs and training histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewatch.spec import ROWS_PER_FILE

LOG_SCHEMA = (
    "timestamp STRING, level STRING, logger STRING, message STRING, module STRING, "
    "function STRING, line INT, engine_id STRING, rul DOUBLE, risk DOUBLE, risk_level STRING, "
    "latency_ms DOUBLE, confidence DOUBLE"
)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_sequences(splits: dict[str, DataFrame], path: str) -> None:
    """Feature windows of all splits as one table with a folder per split."""
    for name, df in splits.items():
        df.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(f"{path}/split={name}")


def read_sequences(spark: SparkSession, path: str, split: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("split") == split).drop("split")


def write_feature_config(
    spark: SparkSession, path: str, window: int, features: Sequence[str], clip: float
) -> None:
    row = [(int(window), list(features), float(clip))]
    spark.createDataFrame(row, "window_size INT, features ARRAY<STRING>, rul_clip DOUBLE").coalesce(
        1
    ).write.mode("overwrite").json(path)


def scaler_export(params: DataFrame, features: Sequence[str]) -> DataFrame:
    """Scaler limits rounded to 8 decimals in feature order; fails on a missing or extra sensor."""
    position = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("sensor"))
    wrong = F.raise_error(F.concat(F.lit("scaler has no feature "), F.col("sensor")))
    checked = F.when(position == 0, wrong).otherwise(F.col("sensor"))
    return params.select(
        position.cast("int").alias("position"),
        checked.alias("sensor"),
        F.round("mn", 8).alias("mn"),
        F.round("mx", 8).alias("mx"),
    )


def write_scaler(
    params: DataFrame, path: str, features: Sequence[str], window: int, clip: float
) -> None:
    """Scaler table plus a one-row JSON sidecar with everything a stream job needs."""
    table = scaler_export(params, features).persist()
    try:
        if table.count() != len(features):
            raise ValueError(f"scaler does not have exactly the {len(features)} listed sensors")
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/scaler")
        limits = F.array_sort(F.collect_list(F.struct("position", "sensor", "mn", "mx")))
        sidecar = table.agg(limits.alias("p")).select(
            F.col("p.sensor").alias("sensors"),
            F.size("p").alias("n_sensors"),
            F.lit(window).alias("window_size"),
            F.lit(float(clip)).alias("rul_clip"),
            F.col("p.mn").alias("data_min"),
            F.col("p.mx").alias("data_max"),
        )
        sidecar.coalesce(1).write.mode("overwrite").json(f"{path}/config")
    finally:
        table.unpersist()


def read_scaler(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/scaler").select("sensor", "mn", "mx")


def read_prediction_log(spark: SparkSession, path: str) -> DataFrame:
    """Structured log lines; prediction fields are NULL on other lines."""
    log = spark.read.schema(LOG_SCHEMA).json(path)
    return log.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def log_lines(timestamp: Column, message: Column, **fields: Column) -> Column:
    """One structured log line as JSON text; NULL fields are left out."""
    columns = [timestamp.alias("timestamp"), F.lit("INFO").alias("level"), message.alias("message")]
    return F.to_json(F.struct(*columns, *[c.alias(name) for name, c in fields.items()]))


def history_epochs(history: DataFrame, metrics: Sequence[str], column: str = "history") -> DataFrame:
    """Map metric -> values per epoch, to one row per epoch (counted from 1)."""
    zipped = F.arrays_zip(*[F.col(column)[m].alias(m) for m in metrics])
    keys = [c for c in history.columns if c != column]
    rows = history.select(*keys, F.posexplode(zipped).alias("_i", "_v"))
    return rows.select(*keys, (F.col("_i") + 1).alias("epoch"), *[F.col("_v")[m].alias(m) for m in metrics])


def history_final(history: DataFrame, metrics: Sequence[str], column: str = "history") -> DataFrame:
    """Last value of each metric."""
    keys = [c for c in history.columns if c != column]
    return history.select(*keys, *[F.element_at(F.col(column)[m], -1).alias(m) for m in metrics])


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Training history file: one JSON object, metric name -> list of values."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.from_json("value", "MAP<STRING, ARRAY<DOUBLE>>").alias("history"))

"""Kafka endpoints. The connector package must be on the session's classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOPIC = "telemetry.raw"
#: Messages of one micro-batch, over all partitions.
MAX_PER_TRIGGER = 500_000


def reader_options(
    servers: str, topic: str = TOPIC, group: str | None = None, max_per_trigger: int | None = MAX_PER_TRIGGER
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if group:
        options["kafka.group.id"] = group
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_topic(spark: SparkSession, servers: str, **settings) -> DataFrame:
    """Stream of messages: ``value`` as text, ``arrival`` = offset.

    Messages are keyed by engine, so all readings of an engine share a partition and the offset
    orders them.
    """
    stream = spark.readStream.format("kafka").options(**reader_options(servers, **settings)).load()
    return stream.select(F.col("value").cast("string"), F.col("offset").alias("arrival"))


def write_topic(messages: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Publish ``key, value`` rows; the key routes an engine to one partition."""
    (
        messages.select(F.col("key").cast("string"), F.col("value").cast("string"))
        .write.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic})
        .save()
    )


def stream_to_topic(messages: DataFrame, servers: str, checkpoint: str, topic: str = TOPIC):
    return (
        messages.select(F.col("key").cast("string"), F.col("value").cast("string"))
        .writeStream.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic})
        .option("checkpointLocation", checkpoint)
        .start()
    )

"""The online feature log on disk: a folder per micro-batch, and snapshots that replace the older ones.

    online/batch=7            latest rows of one micro-batch
    online/upto=6             latest row per engine of the batches 0 to 6

A snapshot counts from the moment its success mark is there, which Spark writes last: that mark is the
pointer, and putting it is one atomic step in any store. Readers take the newest marked snapshot and the
batches after it. Files that the current and the previous snapshot have replaced are removed, one
compaction late, so that a reader who listed them before still finds them.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewatch.operators.ordering import latest_per_key


def _folder(spark: SparkSession, path: str):
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(conf)


def parts(spark: SparkSession, online: str) -> tuple[list[int], list[int]]:
    """Numbers of the marked snapshots and of the micro-batches, rising."""
    target, files = _folder(spark, online)
    found: dict[str, list[int]] = {"upto": [], "batch": []}
    for status in files.listStatus(target):
        name = re.fullmatch(r"(upto|batch)=(\d+)", status.getPath().getName())
        if name and (name[1] == "batch" or files.exists(_folder(spark, f"{online}/{name[0]}/_SUCCESS")[0])):
            found[name[1]].append(int(name[2]))
    return sorted(found["upto"]), sorted(found["batch"])


def current_folders(spark: SparkSession, online: str) -> list[str]:
    """What a reader reads: at most one snapshot, and the micro-batches after it."""
    snapshots, batches = parts(spark, online)
    last = snapshots[-1] if snapshots else -1
    return [f"{online}/upto={n}" for n in snapshots[-1:]] + [f"{online}/batch={n}" for n in batches if n > last]


def read_log(spark: SparkSession, online: str) -> DataFrame:
    """Rows of the current folders; ``batch`` is the micro-batch that wrote a row."""
    folders = current_folders(spark, online)
    snapshot, batches = ([f for f in folders if f"/{kind}=" in f] for kind in ("upto", "batch"))
    parts_read = [spark.read.parquet(snapshot[0])] if snapshot else []
    if batches:
        rows = spark.read.option("basePath", online).parquet(*batches)
        parts_read.append(rows.withColumn("batch", F.col("batch").cast("bigint")))
    if not parts_read:
        raise FileNotFoundError(f"no feature log at {online}")
    return parts_read[0] if len(parts_read) == 1 else parts_read[0].unionByName(parts_read[1])


def compact(
    spark: SparkSession,
    online: str,
    upto: int,
    key: str = "engine_id",
    order: Sequence[str] = ("written_at", "cycle", "batch"),
) -> None:
    """Fold the micro-batches up to ``upto`` into a snapshot, and remove what the one before has replaced.

    Repeating a compaction does nothing; one that was broken off is done again. Views must not ask for a
    time before the newest write of a snapshot, as older rows of an engine are gone then.
    """
    snapshots, batches = parts(spark, online)
    if upto in snapshots or (snapshots and upto < snapshots[-1]) or upto not in batches:
        return
    rows = read_log(spark, online).where(F.col("batch") <= upto)
    latest_per_key(rows, [key], order).write.mode("overwrite").parquet(f"{online}/upto={upto}")
    replaced = [f"batch={n}" for n in batches if snapshots and n <= snapshots[-1]] + [f"upto={n}" for n in snapshots[:-1]]
    for name in replaced:
        target, files = _folder(spark, f"{online}/{name}")
        files.delete(target, True)

"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SETTINGS = {
    # keyed state on disk: it grows with the fleet
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # call-site capture for error messages doubles the time to build a plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def build_session(name: str = "vanewatch", master: str | None = None, **conf: str) -> SparkSession:
    """Session for jobs; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_work_dir() -> str:
    return tempfile.mkdtemp(prefix="vanewatch-")


def work_dir(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return _local_work_dir()


_scopes = threading.local()


def fresh_dir(spark: SparkSession, name: str) -> str:
    path = f"{work_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for scope in getattr(_scopes, "open", ()):
        scope.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables that were made inside, once their results have been used.

    Queries are lazy: write or collect what is wanted before the scope ends. Without a scope the
    tables stay in the work folder until its owner clears it.
    """
    scopes = _scopes.__dict__.setdefault("open", [])
    made: list[str] = []
    scopes.append(made)
    try:
        yield
    finally:
        scopes.pop()
        jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
        for path in made:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)


def materialized(df: DataFrame, name: str = "step", partition_by: Sequence[str] = (), rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` once to the shared folder, in folders by ``partition_by``, and read it back.

    A file gets at most ``rows_per_file`` rows (0: any number).

    Cuts the lineage, survives lost executors, and gives Catalyst the true size of the result,
    so that later joins pick broadcast or shuffle from measured bytes.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.partitionBy(*partition_by).option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

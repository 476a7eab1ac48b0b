"""Restartable stages: what a stage has read, with which settings, and what it has written.

A stage that ends writes a manifest, last of all. When the job runs again, a stage whose manifest names
the same settings, the same inputs and the outputs as they are now is skipped; any other is done again,
on cleared outputs. So a job that broke off goes on where it stopped, a changed input or setting redoes
what follows from it, and an output that was damaged or removed is made anew.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Stage:
    """A step of a job; inputs and outputs are paths of files or folders."""

    name: str
    work: Callable[[], None]
    settings: dict[str, Any]
    inputs: Sequence[str]
    outputs: Sequence[str]


def _target(spark: SparkSession, path: str):
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(conf)


def fingerprint(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Per path the number of files and a hash of their names, sizes and times; tasks list and hash them.

    Contents are not read. A path that does not exist has no files.
    """
    found = []
    for path in paths:
        try:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            # a sum of hashes does not depend on the order of the files
            one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
            n, total = files.agg(F.count(F.lit(1)), F.sum(one)).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            n, total = 0, None
        found.append(f"{path} {n} {total}")
    return found


def _read(spark: SparkSession, path: str) -> dict[str, Any] | None:
    target, files = _target(spark, f"{path}/_SUCCESS")
    if not files.exists(target):
        return None
    row = spark.read.text(path).first()
    return json.loads(row.value) if row else None


def _state(spark: SparkSession, stage: Stage) -> dict[str, Any]:
    return {"settings": stage.settings, "inputs": fingerprint(spark, stage.inputs), "outputs": fingerprint(spark, stage.outputs)}


def run_stages(spark: SparkSession, stages: Sequence[Stage], folder: str) -> list[str]:
    """Run the stages in order; names of those that were not skipped. A stage that fails raises."""
    done = []
    for stage in stages:
        path = f"{folder}/{stage.name}"
        known = _read(spark, path)
        if known is not None and known == json.loads(json.dumps(_state(spark, stage))):
            continue
        for out in (path, *stage.outputs):
            target, files = _target(spark, out)
            files.delete(target, True)
        stage.work()
        done.append(stage.name)
        text = json.dumps(_state(spark, stage))
        spark.createDataFrame([(text,)], "value STRING").coalesce(1).write.mode("overwrite").text(path)
    return done

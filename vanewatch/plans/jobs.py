"""The batch job: seven stages in order, each reading the tables of the one before.

    spark-submit -m vanewatch.plans.jobs --train ... --test ... --rul ... --out ...

A stage that fails raises, and nothing after it runs. Run again, the job goes on where it stopped.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewatch.functions import scalars
from vanewatch.functions.vectors import sensor_row
from vanewatch.operators import evaluation, prepare, quality, training, windows
from vanewatch.plans import manifest
from vanewatch.session import build_session, materialized
from vanewatch.sources import tables, text
from vanewatch.spec import CLIP, DROP_COLUMNS, GATE, KEEP_SENSORS, RAW_COLUMNS, WINDOW


@dataclass(frozen=True)
class Job:
    train: str
    test: str
    rul: str
    out: str
    window: int = WINDOW
    clip: float = CLIP
    epochs: int = 100

    def at(self, name: str) -> str:
        return f"{self.out.rstrip('/')}/{name}"


RAW_FILES = ("train", "test", "RUL")


def ingest(spark: SparkSession, job: Job) -> None:
    """Land each raw file once; a landed one is left alone."""
    for source, name in zip((job.train, job.test, job.rul), RAW_FILES, strict=True):
        text.land(spark, source, job.at(f"bronze/{name}"))


def validate(spark: SparkSession, job: Job) -> None:
    parts = [text.read_landed(spark, job.at(f"bronze/{n}")).withColumn("name", F.lit(n)) for n in RAW_FILES]
    report = quality.validate_files(reduce(DataFrame.unionByName, parts), name=F.col("name"))
    tables.write_table(report, job.at("validation/report"))
    report = spark.read.parquet(job.at("validation/report"))
    tables.write_table(quality.validated_files(report), job.at("validation/files"))
    status = quality.validation_status(report)
    status.coalesce(1).write.mode("overwrite").json(job.at("validation/status"))
    first = status.first()
    if first.status != "passed":
        raise ValueError(f"validation failed: {first.error}")


def transform(spark: SparkSession, job: Job) -> None:
    """Bronze text to the scaled, labelled silver tables, and the scaler limits.

    The parsed rows are written once: limits, lifetimes, units and the scaled tables all read them.
    """

    def rows(name: str) -> DataFrame:
        lines = text.read_landed(spark, job.at(f"bronze/{name}"))
        parsed = prepare.drop_unused(text.telemetry_rows(lines).select(*RAW_COLUMNS), DROP_COLUMNS)
        return materialized(parsed, "parsed")

    train, test = rows("train"), rows("test")
    tables.write_scaler(
        prepare.minmax_fit(train, KEEP_SENSORS), job.at("scaler"), KEEP_SENSORS, job.window, job.clip
    )
    params = tables.read_scaler(spark, job.at("scaler"))
    labelled = prepare.add_rul(prepare.minmax_apply(train, params, KEEP_SENSORS), clip=job.clip)
    tables.write_table(labelled.drop("max_cycle"), job.at("silver/train"))
    final = prepare.attach_positional(text.rul_rows(text.read_landed(spark, job.at("bronze/RUL"))), test)
    scaled = prepare.minmax_apply(test, params, KEEP_SENSORS)
    tables.write_table(prepare.join_final_rul(scaled, final.drop("pos")), job.at("silver/test"))


def features(spark: SparkSession, job: Job) -> None:
    """Silver tables to feature windows for train, validation and test."""
    train = spark.read.parquet(job.at("silver/train"))
    test = spark.read.parquet(job.at("silver/test"))
    sensors = prepare.feature_columns(train)

    def rows(df: DataFrame) -> DataFrame:
        return df.select("unit", "cycle", "RUL", sensor_row(sensors).alias("row"))

    fit, held_out = prepare.train_validation(train)
    sliding = {
        name: windows.sliding_frames(rows(df), "unit", ["cycle"], "row", job.window)
        .select("unit", "cycle", "features", F.col("RUL").cast("double").alias("label"))
        for name, df in (("train", fit), ("validation", held_out))
    }
    last = windows.last_frames(rows(test), "unit", ["cycle"], "row", len(sensors), job.window, label="RUL")
    clipped = scalars.clip_between("RUL", 0, job.clip).alias("label")
    tables.write_sequences(
        {**sliding, "test": last.select("unit", "cycle", "features", clipped)}, job.at("gold")
    )
    tables.write_feature_config(spark, job.at("feature_config"), job.window, sensors, job.clip)


def _rows(spark: SparkSession, job: Job, split: str) -> DataFrame:
    return training.training_rows(tables.read_sequences(spark, job.at("gold"), split), "features", "label", job.clip)


def train(spark: SparkSession, job: Job) -> None:
    model = training.fit_linear(_rows(spark, job, "train"), job.epochs)
    model.write().overwrite().save(job.at("model"))
    history = training.training_history(model, spark).select(F.to_json("history").alias("value"))
    history.coalesce(1).write.mode("overwrite").text(job.at("history"))
    measured = training.validation_rmse(model, _rows(spark, job, "validation"))
    tables.write_table(measured, job.at("training_metrics"))


def evaluate(spark: SparkSession, job: Job) -> None:
    model = LinearRegressionModel.load(job.at("model"))
    scored = model.transform(_rows(spark, job, "test")).select(
        (F.col("y") * float(job.clip)).alias("t"), scalars.denormalized_target("y_pred", job.clip).alias("p")
    )
    tables.write_table(evaluation.evaluation_rows(scored, "t", "p"), job.at("evaluation/results"))
    results = spark.read.parquet(job.at("evaluation/results"))
    evaluation.metrics(results).coalesce(1).write.mode("overwrite").json(job.at("evaluation/metrics"))
    tables.write_table(evaluation.classification_report(results), job.at("evaluation/report"))


def register(spark: SparkSession, job: Job) -> None:
    """Copy the model to the registry when it passes the gate; otherwise only record the result."""
    metrics = spark.read.json(job.at("evaluation/metrics"))
    gate = evaluation.gate(metrics, GATE)
    tables.write_table(gate, job.at("evaluation/gate"))
    if gate.first().promote:
        LinearRegressionModel.load(job.at("model")).write().overwrite().save(job.at("registry/production"))


#: Each stage with the tables it reads and writes.
STAGES: tuple[tuple[Callable[[SparkSession, Job], None], tuple[str, ...], tuple[str, ...]], ...] = (
    (ingest, (), ("bronze",)),
    (validate, ("bronze",), ("validation",)),
    (transform, ("bronze",), ("scaler", "silver")),
    (features, ("silver",), ("gold", "feature_config")),
    (train, ("gold",), ("model", "history", "training_metrics")),
    (evaluate, ("model", "gold"), ("evaluation/results", "evaluation/metrics", "evaluation/report")),
    (register, ("model", "evaluation/metrics"), ("evaluation/gate", "registry")),
)


def run(spark: SparkSession, job: Job, last: str = "register") -> list[str]:
    """All stages up to ``last``; those that are finished and still fit are skipped. Names of the others."""
    stages = []
    for work, reads, writes in STAGES:
        inputs = [job.at(r) for r in reads] if reads else [job.train, job.test, job.rul]
        settings = {"window": job.window, "clip": job.clip, "epochs": job.epochs}
        stages.append(
            manifest.Stage(work.__name__, partial(work, spark, job), settings, inputs, [job.at(w) for w in writes])
        )
        if work.__name__ == last:
            return manifest.run_stages(spark, stages, job.at("manifest"))
    raise ValueError(f"no stage is called {last}")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    for name in ("train", "test", "rul", "out"):
        parser.add_argument(f"--{name}", required=True)
    run(build_session("vanewatch-batch"), Job(**vars(parser.parse_args())))


if __name__ == "__main__":
    main()

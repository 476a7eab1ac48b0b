"""Registered queries over the batch job: raw files from the tables, the job's stages, its sinks read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewatch.plans import jobs
from vanewatch.plans.registry import query
from vanewatch.plans.series import rounded
from vanewatch.plans.testviews import raw_tokens, sql, telemetry
from vanewatch.session import fresh_dir, materialized
from vanewatch.spec import GATE, RAW_COLUMNS


def key() -> list[Column]:
    return [F.col(c).cast("bigint").alias(c) for c in ("unit", "cycle")]


def raw_job(spark: SparkSession, sf_dir: str, **settings) -> jobs.Job:
    """A job on all readings as training and as test file."""
    path = fresh_dir(spark, "job")
    rows = materialized(telemetry(spark, sf_dir).select(*RAW_COLUMNS), "readings")  # read for each file
    lines = raw_tokens(rows).orderBy("unit", "cycle").select(F.array_join("tokens", " "))
    units = rows.select("unit").distinct().orderBy("unit")
    for name in ("train", "test"):
        lines.write.text(f"{path}/{name}")
    units.select(F.pmod(F.col("unit"), F.lit(126)).cast("string")).write.text(f"{path}/rul")
    return jobs.Job(f"{path}/train", f"{path}/test", f"{path}/rul", f"{path}/out", **settings)


def prepared(spark: SparkSession, sf_dir: str, last: str, **settings) -> jobs.Job:
    """The job after the stage named ``last``."""
    job = raw_job(spark, sf_dir, **settings)
    jobs.run(spark, job, last)
    return job


@query(
    "job_silver",
    sql(
        "select unit, cycle, round((s2 - lo) / nullif(hi - lo, 0), 6) as s2, "
        "least(max(cycle) over (partition by unit) - cycle, 125)::double as RUL "
        "from t, (select min(s2) as lo, max(s2) as hi from t)",
        "t",
    ),
)
def job_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed, validated, scaled and labelled training rows."""
    silver = spark.read.parquet(prepared(spark, sf_dir, "transform").at("silver/train"))
    rows = silver.select(*key(), "s2", F.col("RUL").cast("double").alias("RUL"))
    return rounded(rows, "s2")


@query(
    "job_test_lives",
    sql("select unit, cycle, (unit % 126)::double as RUL from t", "t"),
)
def job_test_lives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test reading with the remaining life that its unit got by position in the file."""
    silver = spark.read.parquet(prepared(spark, sf_dir, "transform").at("silver/test"))
    return silver.select(*key(), F.col("RUL").cast("double").alias("RUL"))


@query(
    "job_status",
    sql(
        "select 'passed' as status, 3::bigint as files, 3::bigint as passed_files, count(*) filter (cycle < before) as violations "
        "from (select cycle, lag(cycle) over (partition by unit order by ts, event_id) as before from t)",
        "t",
    ),
)
def job_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of the validation with the violations that its report counts."""
    job = prepared(spark, sf_dir, "validate")
    status = spark.read.schema("status STRING, files BIGINT, error STRING").json(job.at("validation/status"))
    names = spark.read.parquet(job.at("validation/files")).agg(F.count(F.lit(1)))
    found = spark.read.parquet(job.at("validation/report")).agg(F.sum("violations"))
    return status.select("status", "files", names.scalar().alias("passed_files"), found.scalar().alias("violations"))


@query(
    "job_evaluation",
    sql(
        "select count(distinct unit) as results, true as metrics_agree, true as report_agrees, true as gate_agrees from t",
        "t",
    ),
)
def job_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, evaluate and register: the stored metrics, report and gate follow from the stored results."""
    job = prepared(spark, sf_dir, "register", epochs=5)
    results = spark.read.parquet(job.at("evaluation/results"))
    rmse, critical = results.agg(
        F.sqrt(F.avg((F.col("pred_rul") - F.col("true_rul")) ** 2)), F.count_if("critical_true").cast("double")
    ).first()
    stored = spark.read.json(job.at("evaluation/metrics"))
    report = spark.read.parquet(job.at("evaluation/report")).where(F.col("label") == "Critical")
    gate = spark.read.parquet(job.at("evaluation/gate"))
    good = stored.select((F.col("rmse") < GATE["rmse"]) & (F.col("penalty_score") < GATE["penalty_score"])).scalar()
    return results.agg(F.count(F.lit(1)).alias("results")).select(
        "results",
        (F.abs(stored.select("rmse").scalar() - F.lit(rmse)) < 1e-9).alias("metrics_agree"),
        (report.select("support").scalar() == F.lit(critical)).alias("report_agrees"),
        (gate.select("promote").scalar() == good).alias("gate_agrees"),
    )


@query(
    "job_restart",
    sql(
        "select stage, times, case stage when 'transform' then (select count(*) from t) else 0 end::bigint as rows from "
        "(values ('ingest', 1::bigint), ('validate', 1::bigint), ('transform', 2::bigint), ('features', 1::bigint)) s(stage, times)",
        "t",
    ),
)
def job_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job is run, one of its tables is damaged, it is run to the end, and once more for nothing."""
    job = raw_job(spark, sf_dir)
    ran = jobs.run(spark, job, "transform")
    silver = spark.read.parquet(job.at("silver/train"))
    materialized(silver, "kept").where("unit % 2 = 0").write.mode("overwrite").parquet(job.at("silver/train"))
    ran += jobs.run(spark, job, "features") + jobs.run(spark, job, "features")
    rows = spark.read.parquet(job.at("silver/train")).agg(F.count(F.lit(1))).scalar()
    names = spark.createDataFrame([(name,) for name in ran], "stage STRING")
    counted = names.groupBy("stage").agg(F.count(F.lit(1)).alias("times"))
    return counted.select("stage", "times", F.when(F.col("stage") == "transform", rows).otherwise(F.lit(0)).cast("bigint").alias("rows"))


@query(
    "job_gold_counts",
    sql(
        "select split, sum(n)::bigint as windows from ("
        " select case when row_number() over (order by md5(unit || ':42'), unit) <= ceil(0.2 * count(*) over ()) "
        "  then 'validation' else 'train' end as split, greatest(count(*) - 29, 0) as n from t group by unit"
        " union all select 'test', count(distinct unit) from t) group by split having sum(n) > 0",
        "t",
    ),
)
def job_gold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature windows per split."""
    gold = spark.read.parquet(prepared(spark, sf_dir, "features").at("gold"))
    return gold.groupBy(F.col("split").cast("string").alias("split")).agg(F.count(F.lit(1)).alias("windows"))

"""Registered queries over measured vectors: the first eleven entries of ``embeddings`` as sensors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewatch.operators import drift, linear, prepare
from vanewatch.plans.registry import query
from vanewatch.plans.series import rounded
from vanewatch.plans.testviews import table
from vanewatch.spec import KEEP_SENSORS

_X = "x as (select vec_id, label, " + ", ".join(f"embedding[{i}]::double as {s}" for i, s in enumerate(KEEP_SENSORS, 1)) + " from embeddings)"


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = [F.col("embedding")[i].cast("double").alias(s) for i, s in enumerate(KEEP_SENSORS)]
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", *entries)


_LIMITS = ", ".join(f"min({s}) as lo_{s}, max({s}) as hi_{s}" for s in KEEP_SENSORS)


@query(
    "vector_scaling",
    f"with {_X} select vec_id, "
    + ", ".join(f"round(({s} - lo_{s}) / case when hi_{s} = lo_{s} then 1 else hi_{s} - lo_{s} end, 6) as {s}" for s in KEEP_SENSORS)
    + f" from x, (select {_LIMITS} from x where vec_id % 2 = 0)",
)
def vector_scaling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits fitted on every second vector, applied to all."""
    rows = sensors(spark, sf_dir)
    params = prepare.minmax_fit(rows.where(F.col("vec_id") % 2 == 0), KEEP_SENSORS)
    return rounded(prepare.minmax_apply(rows.select("vec_id", *KEEP_SENSORS), params, KEEP_SENSORS), *KEEP_SENSORS)


_LONG = " union all ".join(f"select '{s}' as sensor, {s} as v, label % 2 as cur from x" for s in KEEP_SENSORS)


@query(
    "vector_drift",
    f"with {_X}, lng as ({_LONG}), "
    "n as (select sensor, v, count(*) filter (where cur = 0) as r, count(*) filter (where cur = 1) as c from lng group by sensor, v), "
    "cdf as (select sensor, sum(r) over w / sum(r) over a as f, sum(c) over w / sum(c) over a as g, sum(r) over a as r, sum(c) over a as c "
    "from n window w as (partition by sensor order by v), a as (partition by sensor)) "
    "select sensor, max(r)::bigint as n_reference, max(c)::bigint as n_current, round(max(abs(f - g)), 6) as statistic from cdf group by sensor",
)
def vector_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of even labels next to those of odd ones, sensor by sensor."""
    rows = sensors(spark, sf_dir)
    report = drift.ks_report(rows.where(F.col("label") % 2 == 0), rows.where(F.col("label") % 2 == 1))
    return rounded(report.select("sensor", "n_reference", "n_current", "statistic"), "statistic")


@query(
    "vector_regression",
    f"with {_X}, m as (select count(*)::double as n, avg(s2) as a, avg(label) as y from x) "
    "select round(any_value(y) - sum((s2 - a) * (label - y)) / sum((s2 - a) ** 2) * any_value(a), 6) as bias, "
    "round(sum((s2 - a) * (label - y)) / sum((s2 - a) ** 2), 6) as weight from x, m",
)
def vector_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least squares of the label on one sensor, in one pass."""
    rows = sensors(spark, sf_dir).select(
        F.array("s2").alias("vector"), F.col("label").cast("double").alias("y"), F.lit(1.0).alias("weight")
    )
    model = linear.fit_closed_form(rows, 1, 0.0)
    found = spark.createDataFrame([(model.bias, float(model.weights[0]))], "bias DOUBLE, weight DOUBLE")
    return rounded(found, "bias", "weight")

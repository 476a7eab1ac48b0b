"""Distributed regressors for remaining life on flattened feature windows."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewatch.functions import scalars
from vanewatch.operators.evaluation import rmse
from vanewatch.spec import CLIP, ROWS_PER_FILE, SPLIT_SEED

# --- fixed values: regularisation of the model, members of the uncertainty ensemble --------------
L2 = 1e-4
MEMBERS = 30
# -----------------------------------------------------------------------------------------------


@contextmanager
def bounded_tasks(train: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> Iterator[None]:
    """Inside, each stored file is a task of its own, if there are more rows than one file may have.

    Stored windows repeat their readings, so files that Spark would pack into one task, as they are small on
    disk, become many times larger as the vectors that a solver keeps and reads again in each pass. Windows
    are stored with at most ``rows_per_file`` rows in a file, which then bounds what a task keeps.
    """
    spark, key = train.sparkSession, "spark.sql.files.openCostInBytes"
    if train.count() <= rows_per_file:
        yield
        return
    before = spark.conf.get(key, None)
    # opening a file seems to cost as much as a task may read, so no second one is packed to it
    spark.conf.set(key, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def training_rows(windows: DataFrame, features: str, label: str, clip: float = CLIP) -> DataFrame:
    """(vector, y, weight) from nested windows and a label in cycles."""
    y = scalars.normalized_target(scalars.clip_between(label, 0, clip), clip)
    return windows.select(
        array_to_vector(F.flatten(features).cast("array<double>")).alias("vector"),
        y.alias("y"),
        scalars.sample_weight(y).alias("weight"),
    )


def fit_linear(train: DataFrame, epochs: int = 100, l2: float = L2) -> LinearRegressionModel:
    """Iterative fit: the history has one loss per iteration, at most ``epochs`` of them."""
    solver = LinearRegression(
        featuresCol="vector",
        labelCol="y",
        weightCol="weight",
        predictionCol="y_pred",
        maxIter=epochs,
        regParam=l2,
        solver="l-bfgs",
    )
    with bounded_tasks(train):
        return solver.fit(train)


def fit_forest(train: DataFrame, members: int = MEMBERS, depth: int = 8, seed: int = SPLIT_SEED) -> RandomForestRegressionModel:
    forest = RandomForestRegressor(
        featuresCol="vector",
        labelCol="y",
        weightCol="weight",
        predictionCol="y_pred",
        numTrees=members,
        maxDepth=depth,
        seed=seed,
    )
    with bounded_tasks(train):
        return forest.fit(train)


def with_member_scores(df: DataFrame, model: RandomForestRegressionModel, out: str = "members") -> DataFrame:
    """Score of each tree as one array, the spread of which is the model's uncertainty."""
    names = []
    for i, tree in enumerate(model.trees):
        name = f"_member{i}"
        names.append(name)
        df = _named(tree, name).transform(df)
    return df.withColumn(out, F.array(*names)).drop(*names)


def _named(tree: DecisionTreeRegressionModel, out: str) -> DecisionTreeRegressionModel:
    return tree.setFeaturesCol("vector").setPredictionCol(out)


def validation_rmse(model, rows: DataFrame) -> DataFrame:
    """RMSE of normalised scores, one row."""
    error = F.col("y_pred") - F.col("y")
    return model.transform(rows).agg(rmse(error).alias("val_rmse"), F.count(F.lit(1)).alias("windows"))


def training_history(model: LinearRegressionModel, spark) -> DataFrame:
    """Objective per iteration of the solver as a history map (one row; bounded by maxIter)."""
    values = [float(v) for v in model.summary.objectiveHistory]
    return spark.createDataFrame([({"loss": values},)], "history MAP<STRING, ARRAY<DOUBLE>>")

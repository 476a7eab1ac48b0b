"""Linear models from sums over the training rows: closed form, descent with a curve, bootstrap ensemble.

A pass over the data gives each task one matrix of a size that depends on the features only; matrices are
added in a tree of small groups. The driver solves systems of that size and never sees rows. Rows have a
``vector`` (array of numbers), a label ``y`` and a ``weight``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewatch.session import materialized

#: Matrices that are added together at a time.
FAN = 256
#: Numbers that the driver may add up itself, a row for every FAN tasks.
SHORT = 1024
# --- fixed values: cumulative chances of a Poisson number with mean 1, up to the last that matters ---
POISSON_LEVELS = (
    0.36787944117, 0.73575888234, 0.91969860293, 0.98101184312, 0.99634015317,
    0.99940581518, 0.99991675885, 0.99998975080, 0.99999887480, 0.99999988857,
)
# -----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class LinearModel:
    weights: np.ndarray
    bias: float


def summed(rows: DataFrame, make: Callable[[pa.RecordBatch], np.ndarray], n: int) -> np.ndarray:
    """Sum of ``make`` over all Arrow batches, ``n`` numbers; added in a fixed order, so reruns agree."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(n)
        for batch in batches:
            if batch.num_rows:
                total += make(batch).ravel()
        yield pa.RecordBatch.from_pydict({"task": [TaskContext.get().partitionId()], "part": [total]})

    def added(table: pa.Table) -> pa.Table:
        parts = sorted(zip(table["task"].to_pylist(), table["part"], strict=True), key=lambda p: p[0])
        total = sum((p.values.to_numpy() for _, p in parts), np.zeros(n))
        return pa.table({"task": pa.array([parts[0][0] // FAN], pa.int64()), "part": [total]})

    schema = "task long, part array<double>"
    parts = rows.mapInArrow(partial, schema)
    parts = parts.groupBy(F.floor(F.col("task") / FAN)).applyInArrow(added, schema)
    if n > SHORT:
        parts = parts.groupBy(F.lit(0).alias("all")).applyInArrow(added, schema)
    # a short row for every FAN tasks, or one long row
    return sum((np.array(r.part) for r in sorted(parts.collect(), key=lambda r: r.task)), np.zeros(n))


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """1, features and label side by side."""
    x = batch.column(batch.schema.get_field_index("vector")).flatten().to_numpy(zero_copy_only=False)
    y = batch.column(batch.schema.get_field_index("y")).to_numpy(zero_copy_only=False)
    return np.column_stack([np.ones(batch.num_rows), x.astype(float).reshape(-1, d), y])


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(float)


def _usable(rows: DataFrame, d: int) -> DataFrame:
    """Rows without a label, with a vector of another length or with a missing value teach nothing."""
    whole = F.col("vector").cast("array<double>")
    known = F.forall(whole, lambda v: v.isNotNull() & ~F.isnan(v))
    return rows.where((F.size("vector") == d) & known & F.col("y").isNotNull() & F.col("weight").isNotNull())


def moments(rows: DataFrame, d: int) -> np.ndarray:
    """Weighted sums of the products of 1, the features and the label: one pass, (d + 2) x (d + 2)."""

    def products(batch: pa.RecordBatch) -> np.ndarray:
        z = _matrix(batch, d)
        return z.T @ (z * _column(batch, "weight")[:, None])

    return summed(_usable(rows, d).select("vector", "y", "weight"), products, (d + 2) ** 2).reshape(d + 2, d + 2)


def solved(sums: np.ndarray, l2: float) -> LinearModel:
    """Minimum of the weighted mean of squared errors plus ``l2`` times the squared weights (not the bias)."""
    total = sums[0, 0]
    if total <= 0:
        raise ValueError("no training rows")
    normal = sums[:-1, :-1] / total + l2 * np.diag([0.0] + [1.0] * (len(sums) - 2))
    found = np.linalg.lstsq(normal, sums[:-1, -1] / total, rcond=None)[0]
    return LinearModel(found[1:], float(found[0]))


def fit_closed_form(train: DataFrame, d: int, l2: float = 1e-4) -> LinearModel:
    return solved(moments(train, d), l2)


def mean_squared_error(rows: DataFrame, d: int, model: LinearModel) -> tuple[float, int]:
    """Mean of squared errors without weights, and rows."""
    beta = np.concatenate([[model.bias], model.weights])

    def errors(batch: pa.RecordBatch) -> np.ndarray:
        z = _matrix(batch, d)
        return np.array([((z[:, :-1] @ beta - z[:, -1]) ** 2).sum(), len(z)])

    total, n = summed(_usable(rows, d).select("vector", "y"), errors, 2)
    return (float(total / n) if n else float("nan")), int(n)


@dataclass(frozen=True)
class Curve:
    """Per epoch: weighted loss of the steps, validation error; and the model of the best epoch."""

    loss: list[float]
    val_rmse: list[float]
    best_epoch: int
    model: LinearModel


def descend(
    train: DataFrame,
    validation: DataFrame,
    d: int,
    batch: Column,
    batches: int,
    epochs: int,
    rate: float,
    l2: float = 0.0,
    patience: int | None = None,
) -> Curve:
    """Mini-batch gradient descent; ``batch`` (0 to batches - 1) says when in an epoch a row is used.

    Rows are stored once in a folder per mini-batch, so a step reads its own rows only, all tasks work on
    each step, and a step sends d + 3 numbers. After every epoch the model is judged on the validation rows;
    the model of the best epoch is kept. ``patience`` epochs without a better one end the fit.
    """
    rows = _usable(train, d).select("vector", "y", "weight", batch.cast("int").alias("_batch"))
    stored = materialized(rows, "steps", partition_by=["_batch"])
    held_out = materialized(_usable(validation, d).select("vector", "y", "weight"), "held-out")
    beta = np.zeros(d + 1)
    loss, val, best = [], [], (np.inf, 0, beta)
    for epoch in range(1, epochs + 1):
        errors = weights = 0.0
        for k in range(batches):

            def gradient(b: pa.RecordBatch, beta: np.ndarray = beta) -> np.ndarray:
                z, w = _matrix(b, d), _column(b, "weight")
                miss = z[:, :-1] @ beta - z[:, -1]
                return np.concatenate([z[:, :-1].T @ (w * miss), [(w * miss**2).sum(), w.sum()]])

            found = summed(stored.where(F.col("_batch") == k).drop("_batch"), gradient, d + 3)
            if not found[-1]:
                continue
            errors, weights = errors + found[-2], weights + found[-1]
            step = found[: d + 1] / found[-1]
            step[1:] += l2 * beta[1:]
            beta = beta - rate * step
        loss.append(float(errors / weights) if weights else float("nan"))
        error, _ = mean_squared_error(held_out, d, LinearModel(beta[1:], float(beta[0])))
        val.append(float(np.sqrt(error)))
        if val[-1] < best[0]:
            best = (val[-1], epoch, beta)
        if patience is not None and epoch - best[1] >= patience:
            break
    return Curve(loss, val, best[1], LinearModel(best[2][1:], float(best[2][0])))


def curve_rows(spark, curve: Curve) -> DataFrame:
    """One row per epoch: epoch, loss, val_rmse, best (at most ``epochs`` rows)."""
    rows = [(i, a, b, i == curve.best_epoch) for i, (a, b) in enumerate(zip(curve.loss, curve.val_rmse, strict=True), 1)]
    return spark.createDataFrame(rows, "epoch BIGINT, loss DOUBLE, val_rmse DOUBLE, best BOOLEAN")


# --- ensemble --------------------------------------------------------------------------------------


def poisson_weights(key: Column, members: int, seed: int = 0) -> Column:
    """For each member how often a resample holds the row: Poisson numbers from a hash of key and member.

    No row knows how many others there are, so a resample needs no second pass and no order.
    """

    def one(member: Column) -> Column:
        text = F.concat_ws(":", key.cast("string"), member.cast("string"), F.lit(str(seed)))
        chance = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(1 << 32)
        return sum((F.when(chance >= level, 1).otherwise(0) for level in POISSON_LEVELS), F.lit(0))

    return F.transform(F.sequence(F.lit(0), F.lit(members - 1)), one)


def fit_bootstrap(train: DataFrame, d: int, key: Column, members: int, l2: float = 1e-4, seed: int = 0) -> list[LinearModel]:
    """Models of Poisson resamples of the rows; the sums of all members come from one pass."""
    n = d + 2

    def products(batch: pa.RecordBatch) -> np.ndarray:
        z, w = _matrix(batch, d), _column(batch, "weight")
        times = batch.column(batch.schema.get_field_index("times")).flatten().to_numpy().reshape(-1, members)
        return np.stack([z.T @ (z * (w * times[:, m])[:, None]) for m in range(members)])

    rows = _usable(train, d).select("vector", "y", "weight", poisson_weights(key, members, seed).alias("times"))
    sums = summed(rows, products, members * n * n).reshape(members, n, n)
    return [solved(s, l2) for s in sums]


def member_scores(vector: Column | str, models: list[LinearModel]) -> Column:
    """Scores of all members as one array: a matrix product per Arrow batch. Misfit vectors score NULL."""
    weights = np.array([m.weights for m in models]).T
    bias = np.array([m.bias for m in models])
    d, members = weights.shape

    @F.arrow_udf("array<double>")
    def score(batch: pa.Array) -> pa.Array:
        ends = batch.offsets.to_numpy()
        fits = (np.diff(ends) == d) & batch.is_valid().to_numpy(zero_copy_only=False)
        chosen = batch if fits.all() else batch.filter(pa.array(fits))
        flat = chosen.flatten().to_numpy(zero_copy_only=False).astype(float)
        found = flat.reshape(-1, d) @ weights + bias
        offsets = np.concatenate([[0], np.cumsum(fits * members)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()), mask=pa.array(~fits))

    return score(vector)

"""Linear models from sums over the rows, against numpy on the gathered rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vanewatch.operators import linear, training
from vanewatch.session import materialized

D = 3
SCHEMA = "id long, vector array<float>, y double, weight double, held_out boolean"


@pytest.fixture(scope="module")
def data(spark):
    """Rows of a noisy plane; some cannot be used."""
    rng = np.random.default_rng(3)
    x = rng.random((400, D)).astype(np.float32)
    y = x @ [0.5, -0.2, 0.3] + 0.1 + rng.normal(0, 0.05, 400)
    w = rng.uniform(1, 2.5, 400)
    rows = [(i, [float(v) for v in x[i]], float(y[i]), float(w[i]), i % 5 == 0) for i in range(400)]
    bad = [(900, None, 1.0, 1.0, False), (901, [1.0, 2.0], 1.0, 1.0, False), (902, [1.0, None, 2.0], 1.0, 1.0, False),
           (903, [1.0, float("nan"), 0.0], 9.0, 1.0, False), (904, [1.0, 1.0, 1.0], None, 1.0, False), (905, [9.0, 9.0, 9.0], 1.0, None, False)]
    df = spark.createDataFrame(rows + bad, SCHEMA).repartition(7)
    held = np.arange(400) % 5 == 0
    return df.where("not held_out"), df.where("held_out"), x.astype(float), y, w, held


def ridge(x, y, w, l2):
    z = np.column_stack([np.ones(len(x)), x])
    normal = (z.T * w) @ z / w.sum() + l2 * np.diag([0, *[1] * D])
    return np.linalg.solve(normal, (z.T * w) @ y / w.sum())


def test_closed_form(data):
    train, held_out, x, y, w, held = data
    model = linear.fit_closed_form(train, D, 0.01)
    beta = ridge(x[~held], y[~held], w[~held], 0.01)
    assert np.allclose([model.bias, *model.weights], beta, atol=1e-12)
    error, n = linear.mean_squared_error(held_out, D, model)
    assert n == held.sum() and error == pytest.approx((((x[held] @ beta[1:] + beta[0]) - y[held]) ** 2).mean())


def test_sums_do_not_depend_on_the_tree(data, monkeypatch):
    train = data[0]
    whole = linear.moments(train, D)
    monkeypatch.setattr(linear, "FAN", 2)
    monkeypatch.setattr(linear, "SHORT", 1)
    assert np.allclose(linear.moments(train, D), whole, atol=1e-12)


@pytest.mark.parametrize("patience", [None, 1])
def test_curve_of_the_descent(data, patience):
    """Every epoch equals a numpy run over the same mini-batches."""
    train, held_out, x, y, w, held = data
    rate = 0.9
    curve = linear.descend(train, held_out, D, F.col("id") % 3, 3, 4, rate, 0.01, patience)
    z, ids, beta = np.column_stack([np.ones(400), x]), np.arange(400), np.zeros(D + 1)
    best = (np.inf, 0, None)
    for epoch in range(4):
        errors = weights = 0.0
        for k in range(3):
            at = ~held & (ids % 3 == k)
            miss = z[at] @ beta - y[at]
            errors, weights = errors + (w[at] * miss**2).sum(), weights + w[at].sum()
            step = z[at].T @ (w[at] * miss) / w[at].sum()
            step[1:] += 0.01 * beta[1:]
            beta = beta - rate * step
        rmse = np.sqrt(((z[held] @ beta - y[held]) ** 2).mean())
        assert curve.loss[epoch] == pytest.approx(errors / weights) and curve.val_rmse[epoch] == pytest.approx(rmse)
        if rmse < best[0]:
            best = (rmse, epoch + 1, beta)
        elif patience:
            break
    assert len(curve.loss) == epoch + 1 and curve.best_epoch == best[1]
    assert np.allclose([curve.model.bias, *curve.model.weights], best[2])


def test_bootstrap(spark, data):
    train, held_out, x, y, w, held = data
    models = linear.fit_bootstrap(train, D, F.col("id"), 12, 0.01, seed=4)
    times = {r.id: r.t for r in train.select("id", linear.poisson_weights(F.col("id"), 12, 4).alias("t")).collect()}
    drawn = np.array([times[i] for i in np.flatnonzero(~held)])
    for m, model in enumerate(models):
        beta = ridge(x[~held], y[~held], w[~held] * drawn[:, m], 0.01)
        assert np.allclose([model.bias, *model.weights], beta, atol=1e-10)
    got = {r.id: r.s for r in held_out.select("id", linear.member_scores("vector", models).alias("s")).collect()}
    assert np.allclose(got[5], [x[5] @ m.weights + m.bias for m in models])
    misfit = train.where("id in (900, 901)").select(linear.member_scores("vector", models).alias("s")).collect()
    assert [r.s for r in misfit] == [None, None]


def test_poisson_numbers(spark):
    rows = spark.range(4000).select(F.explode(linear.poisson_weights(F.col("id"), 5)).alias("n"))
    counts = {r.n: r["count"] / 20000 for r in rows.groupBy("n").count().collect()}
    assert all(abs(counts[k] - np.exp(-1) / [1, 1, 2, 6][k]) < 0.012 for k in range(4))


def test_no_rows(data):
    with pytest.raises(ValueError, match="no training rows"):
        linear.fit_closed_form(data[0].limit(0), D)


def test_a_fit_reads_a_file_per_task(spark):
    """Files that are small on disk are not packed into one task, and the setting is as before afterwards."""
    rows = spark.range(4000, numPartitions=1).select(F.col("id").cast("double").alias("x"))
    stored = materialized(rows, "windows", rows_per_file=500)
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)

    def largest():
        return stored.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]

    assert largest() > 500
    with training.bounded_tasks(stored, 500):
        assert largest() == 500
    assert spark.conf.get(key) == before and largest() > 500
    with training.bounded_tasks(stored, 4000):
        assert spark.conf.get(key) == before

"""FEAST against numpy's eigensolver, whitening against its definition."""

import math

import numpy as np
import pytest

from vanewatch.llm import whitening
from vanewatch.llm.queries import QUERIES


def covariance(rng, spectrum):
    q = np.linalg.qr(rng.standard_normal((len(spectrum), len(spectrum))))[0]
    v = (q * spectrum) @ q.T
    return 0.5 * (v + v.T)


SPECTRA = {
    "falling": np.arange(40, 0, -1.0),
    "wide": 10.0 ** np.linspace(6, -5, 30),
    "ties": np.array([5.0] * 3 + [4.0] * 9 + [1.0] * 8),
    "close": 1 + 1e-7 * np.arange(25),
    "few": np.array([9.0, 4.0, 1.0] + [0.0] * 12),
    "one": np.array([3.0]),
    "flat": np.full(12, 2.0),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_intervals_miss_no_eigenvalue(name):
    v = covariance(np.random.default_rng(5), SPECTRA[name])
    true = np.sort(np.linalg.eigvalsh(v))[::-1]
    found, vectors = [], []
    for low, high, count in whitening.intervals(v, 8):
        assert count == ((true > low) & (true <= high)).sum() == whitening.eigenvalues_above(v, low) - whitening.eigenvalues_above(v, high)
        values, columns = whitening.feast(v, low, high, count)
        found += values.tolist()
        vectors.append(columns)
    wanted = true[true > 1e-12 * true[0]][:8]
    assert np.allclose(found[: len(wanted)], wanted, rtol=0, atol=1e-13 * true[0])
    q = np.hstack(vectors)[:, : len(wanted)]
    assert np.abs(q.T @ q - np.eye(len(wanted))).max() < 1e-8
    assert np.abs(v @ q - q * np.array(found[: len(wanted)])).max() < 1e-13 * true[0] * len(v)


def test_inertia_of_awkward_matrices():
    assert whitening.eigenvalues_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
    assert whitening.eigenvalues_above(np.zeros((3, 3)), 0.0) == 0
    rng = np.random.default_rng(0)
    for _ in range(30):
        a = rng.integers(-2, 3, (9, 9)).astype(float)
        a = a + a.T
        s = float(rng.uniform(-3, 3))
        assert whitening.eigenvalues_above(a, s) == (np.linalg.eigvalsh(a) > s).sum()


def check(rows, ids, x, k):
    """Rows of the result against integers x, one row each."""
    n, d = x.shape
    sums = [int(s) for s in x.astype(object).sum(0)]
    centred = x - np.array(sums) / n
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    assert len(rows) == n * k
    found = {}
    for r in rows:
        found.setdefault(r.vec_id, {})[r.component] = r
    wanted = centred @ axes / np.sqrt(values)
    got = np.array([[found[i][c].whitened for c in range(1, k + 1)] for i in ids])
    sign = np.sign((got * wanted).sum(0))
    assert np.abs(got - wanted * sign).max() < 1e-8
    for i, row in zip(ids, x, strict=True):
        exact = sum((n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True))
        assert {(r.n, r.deviation) for r in found[i].values()} == {(n, exact)}
    for c in range(1, k + 1):
        assert math.isclose(found[ids[0]][c].explained, values[c - 1] / np.trace(v), rel_tol=1e-9)
    w = got - got.mean(0)
    assert abs(rows[0].identity_error - np.abs(w.T @ w / n - np.eye(k)).max()) < 1e-9 and rows[0].identity_error < 1e-8


def test_query(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    x = np.floor(1024 * np.array([r.embedding for r in table], float)).astype(np.int64) + 100_000
    check(QUERIES["op13_embedding_whitening"](spark, sf_dir).collect(), [r.vec_id for r in table], x, 8)


SCHEMA = "vec_id long, embedding array<float>, component int, n string, vector int"


def test_awkward_vectors(spark):
    """Nulls, NaN and infinity, other lengths, repeated and null ids, clashing column names."""
    rng = np.random.default_rng(8)
    good = rng.standard_normal((40, 3)).astype(np.float32) * [4, 2, 1]
    rows = [(i, [float(c) for c in g], 7, "n", None) for i, g in enumerate(good)]
    bad = [None, [], [1.0, None, 2.0], [1.0, math.nan, 0.0], [math.inf, 0.0, 0.0], [1.0, 2.0], [-math.inf] * 3]
    df = spark.createDataFrame(rows + [(100 + i, b, None, None, i) for i, b in enumerate(bad)], SCHEMA)
    x = np.floor(1024 * good.astype(float)).astype(np.int64) + 100_000
    check(whitening.whitened(df).collect(), list(range(40)), x, 3)

    nameless = df.unionByName(df.where("vec_id < 5").selectExpr("cast(null as long) as vec_id", *df.columns[1:]))
    found = whitening.whitened(nameless.unionByName(df.where("vec_id = 7"))).collect()
    assert len(found) == 46 * 3 and sum(r.vec_id is None for r in found) == 15
    assert sorted(r.component for r in found if r.vec_id == 7) == [1, 1, 2, 2, 3, 3]
    assert len({r.whitened for r in found if r.vec_id == 7}) == 3
    assert found[0].identity_error < 1e-9


def test_nothing_to_whiten(spark):
    none = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([(1, [1.0, 2.0], 0, "", 0)], SCHEMA)
    same = spark.createDataFrame([(i, [1.0, 2.0], 0, "", 0) for i in range(9)], SCHEMA)
    for df in (none, one, same):
        assert whitening.whitened(df).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0], 0, "", 0) for i in range(9)], SCHEMA)
    rows = whitening.whitened(line).collect()
    assert {r.component for r in rows} == {1} and abs(rows[0].explained - 1) < 1e-12


def test_deviations_beyond_64_bits():
    x = np.array([[0], [4 << 30], [0]])
    sums = x.sum(0)
    assert whitening._deviation(x, sums, 3).tolist() == [min((3 * int(a) - int(sums[0])) ** 2, 2**63 - 1) for a in x[:, 0]]

"""Whitening of vectors by FEAST: contour integrals of shifted covariance solves.

Three passes over the vectors: counts and sums per dimension (exact, in integers), the covariance (centred
before multiplying, one partial matrix per task, summed by row), and the covariance of the result. What
the driver and the tasks hold in between depends on the dimension only: d x d numbers.

The spectrum is cut into intervals by inertia: an LDL^T factorisation of V - sI has as many positive
pivots as V has eigenvalues above s. Each interval is a task of its own. There a circle through the
interval's ends is sampled at Gauss-Legendre nodes z, the complex systems (zI - V) Y = Q are solved for a
block Q, and the weighted sum of the solutions projects Q onto the eigenvectors inside. Rayleigh-Ritz on
the projected block gives eigenpairs; the block is projected again until their residuals stop at rounding
level. An interval is accepted only when it yields as many eigenvalues as its inertia count says, so that
none can be missed; else the block grows.

Entries c become floor(scale * c) + shift, as integers (beyond 2^40 they stay at 2^40). Vectors that are
null or empty or hold null, NaN or infinite entries are dropped; so are vectors of another length than the
most frequent one (of equally frequent ones the longest). Ids may be null or repeat, rows are handled one
by one; other columns are not read. Components with no variance (an eigenvalue below 1e-12 of V's norm)
have no whitened value and are left out, so equal vectors or a single one, like an empty table, give no
rows. A deviation beyond 64 bits stays at 2^63 - 1. Signs are chosen so that a component's largest entry is positive.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewatch.session import materialized

#: Nodes of the upper half circle; V is real and symmetric, so the lower half adds the conjugate.
NODES = 8
#: Eigenvalues wanted in an interval at most; close ones may be more.
PER_INTERVAL = 6
#: An eigenvalue below this part of the norm counts as none.
NOTHING = 1e-12
LARGEST = 1 << 40
#: Tasks whose sums are added together.
FAN = 256
WHITENED = "id {kind}, component int, deviation long, whitened double"


# --- small dense algebra: d x d ---------------------------------------------------------------------


def eigenvalues_above(v: np.ndarray, s: float) -> int:
    """Inertia of V - sI: positive pivots of its LDL^T factorisation, with one- and two-row pivots."""
    a = v - s * np.eye(len(v))
    above = 0
    while len(a):
        size = np.abs(a)
        diagonal = np.diagonal(size).copy()
        np.fill_diagonal(size, 0.0)
        p = int(diagonal.argmax())
        r, c = divmod(int(size.argmax()), len(a))
        if diagonal[p] == 0 and size[r, c] == 0:
            break  # what is left equals s
        block = [p] if diagonal[p] >= 0.64 * size[r, c] else [r, c]
        rest = np.setdiff1d(np.arange(len(a)), block)
        pivot, side = a[np.ix_(block, block)], a[np.ix_(rest, block)]
        above += 1 if len(block) == 2 else int(pivot[0, 0] > 0)  # such a pair has one eigenvalue on either side
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(pivot, side.T)
        a = 0.5 * (a + a.T)
    return above


def intervals(v: np.ndarray, components: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside) from the top down, until ``components`` are covered.

    Ends are moved into gaps: of eight places around a bisection point the one that stays clear longest.
    """
    norm = float(np.abs(v).sum(1).max(initial=0.0))  # no eigenvalue is larger
    floor = NOTHING * norm
    top = norm * (1 + 1e-9) + np.finfo(float).tiny
    wanted = min(components, eigenvalues_above(v, floor))
    found: list[tuple[float, float, int]] = []
    high, done = top, 0
    while done < wanted:
        low, inside = floor, eigenvalues_above(v, floor) - done
        least, most = floor, high
        while inside > PER_INTERVAL and most - least > 1e-10 * norm:
            middle = 0.5 * (least + most)
            n = eigenvalues_above(v, middle) - done
            if n == 0:
                most = middle
            else:
                least, low, inside = middle, middle, n
        low = _clear(v, low, 0.5 * (high - low), done + inside)
        found.append((low, high, inside))
        high, done = low, done + inside
    return found


def _clear(v: np.ndarray, s: float, reach: float, count: int) -> float:
    """Of the values with the same count around ``s`` the middle one, so that no eigenvalue is close."""
    low, high, step = s, s, reach
    for _ in range(40):
        if eigenvalues_above(v, low - step) == count:
            low -= step
        if eigenvalues_above(v, high + step) == count:
            high += step
        step /= 2
        if step < 1e-3 * (high - low):
            break
    return 0.5 * (low + high)


def feast(v: np.ndarray, low: float, high: float, count: int, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between ``low`` and ``high`` and their vectors as columns."""
    d = len(v)
    center, radius = 0.5 * (low + high), 0.5 * (high - low)
    place, weight = np.polynomial.legendre.leggauss(nodes)
    angle = 0.5 * np.pi * (place + 1)  # the upper half circle
    norm = np.linalg.norm(v)
    size = min(d, max(2 * count, count + 3))
    while True:
        q = np.linalg.qr(np.random.default_rng(d * 1000 + size).standard_normal((d, size)))[0]
        best = np.inf
        for _ in range(60):
            projected = np.zeros_like(q)
            for t, w in zip(angle, weight, strict=True):
                turn = np.exp(1j * t)
                solved = np.linalg.solve((center + radius * turn) * np.eye(d) - v, q.astype(complex))
                projected += 0.5 * w * radius * (turn * solved).real
            basis = np.linalg.qr(projected)[0]
            values, inner = np.linalg.eigh(basis.T @ v @ basis)  # Rayleigh-Ritz: size x size
            q = basis @ inner
            inside = (values > low) & (values <= high)
            residual = np.linalg.norm(v @ q[:, inside] - q[:, inside] * values[inside], axis=0).max(initial=0.0)
            if inside.sum() == count and residual <= 4 * np.finfo(float).eps * norm:
                break
            if inside.sum() == count and residual <= 1e-13 * norm and residual >= 0.5 * best:
                break  # at rounding level and no longer falling
            best = min(best, residual) if inside.sum() == count else np.inf
        else:
            if size == d:
                raise ArithmeticError(f"{inside.sum()} of {count} eigenvalues between {low} and {high}")
            size = min(d, 2 * size)
            continue
        order = np.argsort(-values[inside], kind="stable")
        return values[inside][order], q[:, inside][:, order]


def leading_components(spark: SparkSession, v: np.ndarray, components: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues of a covariance, falling, and unit vectors as rows; an interval is a task."""
    cuts = intervals(v, components) if len(v) else []
    if not cuts:
        return np.zeros(0), np.zeros((0, len(v)))

    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                values, vectors = feast(v, low, high, count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values), pa.array(list(vectors.T), pa.list_(pa.float64()))], ["value", "vector"]
                )

    rows = spark.createDataFrame([(float(a), float(b), int(n)) for a, b, n in cuts], "low double, high double, n int")
    found = rows.repartition(len(cuts)).mapInArrow(solve, "value double, vector array<double>")
    pairs = sorted(found.collect(), key=lambda r: -r.value)[:components]  # some vectors of length d
    vectors = np.array([r.vector for r in pairs])
    sign = np.sign(vectors[np.arange(len(pairs)), np.abs(vectors).argmax(1)])
    return np.array([r.value for r in pairs]), vectors * sign[:, None]


# --- passes over the vectors ------------------------------------------------------------------------


def usable(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """id and vector of the rows that take part."""
    bad = F.exists(F.col("vector").cast("array<double>"), lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.select(F.col(id_column).alias("id"), F.col(column).alias("vector"))
    rows = rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & ~F.coalesce(bad, F.lit(False)))
    lengths = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("vector") == (lengths["d"] if lengths else 0))


def _integers(column: pa.Array, scale: float, shift: int) -> np.ndarray:
    """Rows of integers, one per vector."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    whole = np.clip(np.floor(scale * flat), -LARGEST, LARGEST).astype(np.int64) + shift
    return whole.reshape(len(column), -1) if len(column) else whole.reshape(0, 0)


def _summed(rows: DataFrame, make, d: int, width: int, kind: str) -> np.ndarray:
    """Sum of a d x width matrix over tasks: a task sends its rows once, equal rows are added by Spark.

    ``make`` gives a batch's matrix. Entries are summed in the order of the tasks, so reruns agree.
    """

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for batch in batches:
            if batch.num_rows:
                part = make(batch.column(0))
                total = part if total is None else total + part
        if total is not None:
            n = len(total)
            columns = [np.full(n, TaskContext.get().partitionId()), np.arange(n)]
            values = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), values], ["task", "i", "part"])

    def added(key, table):
        total = sum(part.values.to_numpy() for _, part in sorted(zip(table["task"].to_pylist(), table["part"], strict=True)))
        return pa.table({"task": [key[1].as_py()], "i": [key[0].as_py()], "part": pa.array([total])})

    parts = rows.mapInArrow(partial, f"task long, i long, part array<{kind}>")
    schema = parts.schema
    for tasks in (F.floor(F.col("task") / FAN), F.lit(0).cast("bigint")):  # groups of short rows: a tree
        parts = parts.groupBy("i", tasks.alias("of")).applyInArrow(added, schema)
    total = parts.collect()
    result = np.zeros((d, width), np.int64 if kind == "long" else float)
    for r in total:
        result[r.i] = r.part
    return result


def whitened(
    vectors: DataFrame, components: int = 8, scale: float = 1024.0, shift: int = 100_000, id_column: str = "vec_id",
    column: str = "embedding",
) -> DataFrame:
    """Rows id, component, n, deviation, whitened, explained, identity_error, one per vector and component."""
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)[id_column]
    rows = materialized(usable(vectors, id_column, column), "vectors")
    first = rows.select(F.size("vector")).first()
    d = first[0] if first else 0

    def counted(values: pa.Array) -> np.ndarray:
        x = _integers(values, scale, shift)
        return np.append(x.sum(0), len(x))[:, None]

    sums = _summed(rows.select("vector"), counted, d + 1, 1, "long")[:, 0] if d else np.zeros(1, np.int64)
    n, sums = int(sums[-1]), sums[:-1]
    mean = _mean(sums, n)

    def scatter(values: pa.Array) -> np.ndarray:
        x = _centred(_integers(values, scale, shift), mean)
        return x.T @ x

    v = _summed(rows.select("vector"), scatter, d, d, "double") / max(n, 1)
    v = 0.5 * (v + v.T)
    values, axes = leading_components(spark, v, components)
    k = len(values)
    explained = (values / np.trace(v)).tolist() if k else []
    project = axes / np.sqrt(values)[:, None] if k else axes

    def spread(values: pa.Array) -> np.ndarray:
        return (_centred(_integers(values, scale, shift), mean) @ project.T).sum(0)[:, None]

    def gram(values: pa.Array) -> np.ndarray:
        w = _centred(_integers(values, scale, shift), mean) @ project.T - middle
        return w.T @ w

    error = 0.0
    if k:
        middle = _summed(rows.select("vector"), spread, k, 1, "double")[:, 0] / n
        error = float(np.abs(_summed(rows.select("vector"), gram, k, k, "double") / n - np.eye(k)).max())

    def project_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x = _integers(batch.column(1), scale, shift)
            w = _centred(x, mean) @ project.T
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), k)))
            parts = [np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)), np.repeat(_deviation(x, sums, n), k), w.ravel()]
            yield pa.RecordBatch.from_arrays([ids, *map(pa.array, parts)], ["id", "component", "deviation", "whitened"])

    found = rows.select("id", "vector").mapInArrow(project_rows, WHITENED.format(kind=kind))
    share = F.get(F.array(*map(F.lit, explained)), F.col("component") - 1) if k else F.lit(None).cast("double")
    return found.select(
        F.col("id").alias(id_column), "component", F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        share.alias("explained"), F.lit(error).alias("identity_error"),
    )


def _mean(sums: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole part and rest of the means: both exact enough to subtract without loss."""
    whole = sums // max(n, 1)
    return whole, (sums - whole * n) / max(n, 1)


def _centred(x: np.ndarray, mean: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return (x - mean[0]).astype(float) - mean[1]


def _deviation(x: np.ndarray, sums: np.ndarray, n: int) -> np.ndarray:
    """Sum of (n * x - S)^2, exact; in Python's integers where 64 bits might not hold it."""
    whole = sums // n
    most = int(np.abs(x - whole).max(initial=0)) + 1
    if (most * n) ** 2 * x.shape[1] < 1 << 62:
        return ((n * (x - whole) - (sums - whole * n)) ** 2).sum(1)
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return np.array([min(e, (1 << 63) - 1) for e in exact], np.int64)

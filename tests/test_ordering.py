import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vanewatch.operators.ordering import (
    Before,
    last_per_key,
    latest_per_key,
    running,
    slice_large_keys,
    with_ordinal,
)


def rows(seed=1, n=400):
    """Two thirds of the rows in key 0, gaps and bursts in t."""
    rng = random.Random(seed)
    out, t = [], 0
    for i in range(n):
        t += rng.choice([0, 1, 1, 2, 50])
        value = rng.choice([None, rng.randint(-5, 5), rng.randint(0, 100)])
        out.append((rng.choice([0, 0, 0, 0, 1, 2]), t, i, value))
    return out


def expected(data):
    seen, out = {}, {}
    for key, t, i, v in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        past = seen.setdefault(key, [])
        known = [x for x in past if x is not None]
        out[i] = (len(past), sum(known), max(known) if known else None, past[-1] if past else None)
        past.append(v)
    return out


OUT = {
    "n": Before("count"),
    "total": Before("sum", "v"),
    "top": Before("max", "v"),
    "prev": Before("lag", "v"),
}


@pytest.mark.parametrize("size", [1, 7, 60, 10_000])
def test_running_equals_a_loop_for_any_slice_size(spark, size):
    data = rows()
    df = spark.createDataFrame(data, "k int, t bigint, i int, v int").repartition(5)
    got = running(df, ["k"], ["t", "i"], OUT, rows_per_slice=size).collect()
    assert {r.i: (r.n, r.total, r.top, r.prev) for r in got} == expected(data)


def test_running_over_timestamps_and_without_keys(spark):
    base = dt.datetime(2024, 3, 30, 22)
    data = [(0, base + dt.timedelta(minutes=13 * t), i, v) for _, t, i, v in rows(3, 200)]
    df = spark.createDataFrame(data, "k int, t timestamp_ntz, i int, v int")
    got = running(df, [], ["t", "i"], OUT, rows_per_slice=9).collect()
    assert {r.i: (r.n, r.total, r.top, r.prev) for r in got} == expected(data)


def test_slices_cut_only_large_keys_and_follow_the_order(spark):
    df = spark.createDataFrame(rows(), "k int, t bigint, i int, v int")
    got = slice_large_keys(df, ["k"], ["t", "i"], 100)
    assert got.where("k <> 0").agg(F.max("_slice")).first()[0] == 0
    big = [r._slice for r in got.where("k = 0").orderBy("t", "i").collect()]
    assert big == sorted(big) and max(big) >= 2


@pytest.mark.parametrize("odd", [[], [1e9], [float("nan")], [float("inf")], None, [None] * 3000])
def test_slices_are_even_whatever_the_values_are(spark, odd):
    """An outlier, NaN, infinity, nulls, or one value for all rows do not put a key back into one slice."""
    values = [float(i) for i in range(10_000)] if odd is not None else [7.0] * 10_000
    data = [(0, v, i) for i, v in enumerate(values + (odd or []))] + [(None, 1.0, -1)]
    df = spark.createDataFrame(data, "k int, t double, i int").repartition(6)
    sliced = slice_large_keys(df, ["k"], ["t", "i"], 1000)
    assert max(r["count"] for r in sliced.groupBy("k", "_slice").count().collect()) < 2000
    got = {r.i: r.c for r in with_ordinal(df, ["k"], ["t", "i"], "c", 1000).collect()}
    order = sorted((r for r in data if r[0] == 0), key=lambda r: (r[1] is not None, r[1] != r[1], r[1] or 0, r[2]))
    assert [got[r[2]] for r in order] == list(range(1, len(order) + 1)) and got[-1] == 1


def test_ordinal_last_and_latest(spark):
    df = spark.createDataFrame(rows(), "k int, t bigint, i int, v int")
    ordinal = with_ordinal(df, ["k"], ["t", "i"], "c", 20)
    stats = ordinal.groupBy("k").agg(F.count("*").alias("n"), F.max("c").alias("m"), F.countDistinct("c").alias("d"))
    assert all(r.n == r.m == r.d for r in stats.collect())
    newest = {r.k: r.i for r in latest_per_key(df, ["k"], ["t", "i"]).collect()}
    back = last_per_key(df, ["k"], ["t", "i"], 3).collect()
    assert len(back) == 9
    assert {r.k: r.i for r in back if r._back == 1} == newest

"""Rolling windows and alerts as streams, against loops and against their batch twins."""

import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vanewatch.operators import drift, ordering, windows
from vanewatch.session import materialized, work_dir
from vanewatch.sources import events, featurelog, kafka
from vanewatch.spec import KEEP_SENSORS
from vanewatch.streaming.alerts import opened_alerts
from vanewatch.streaming.jobs import monitor_drift, offline_table, online_view, store_features
from vanewatch.streaming.rolling import normalized_events, rolling_features
from vanewatch.streaming.telemetry import telemetry_ticks

LIMITS = {s: (0.0, 40.0) for s in KEEP_SENSORS}
SCHEMA = "arrival bigint, value string"


def event(engine, cycle, value, /, **override):
    body = {
        "engine_id": engine,
        "cycle": cycle,
        "event_time_ms": 1_700_000_000_000 + cycle * 60_000,
        "sensors": {s: value for s in KEEP_SENSORS},
    }
    body.update(override)
    return json.dumps({k: v for k, v in body.items() if v is not None})


def run(spark, root, batches, window=30, written_at=None):
    """Send each batch of JSON texts, restarting the query from its checkpoint in between."""
    arrival = 0
    for batch in batches:
        rows = []
        for text in batch:
            rows.append((arrival, text))
            arrival += 1
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in")
        features = rolling_features(normalized_events(stream, LIMITS), len(LIMITS), window)
        store_features(
            features, f"{root}/online", f"{root}/offline", f"{root}/cp", every=None, written_at=written_at
        ).awaitTermination()
    return offline_table(spark, f"{root}/offline")


@pytest.mark.parametrize("n", [30, 31])
def test_thirty_events_make_one_vector(spark, tmp_path, n):
    rows = run(spark, str(tmp_path), [[event("DRY-RUN-1", i + 1, float(i)) for i in range(n)]])
    got = rows.orderBy("cycle").collect()
    assert len(got) == n - 29
    assert all(len(r.features) == 330 and r.window_size == 30 and r.n_sensors == 11 for r in got)
    assert got[-1].features[0] == np.float32((n - 30) / 40.0)
    assert (got[0].date, got[0].hour) == ("2023-11-14", "22")


def test_late_duplicate_broken_and_missing(spark, tmp_path):
    texts = [
        event("A", 1, 4.0),
        event("A", 2, 8.0),
        event("A", 2, 99.0),  # duplicate
        "{broken",
        event("A", 7, 1.0, cycle=None),  # no cycle
        event("A", 9, 12.0),  # gap
        event("A", 3, 50.0),  # late
        event("B", 5, -3.0),
        event("A", 10, 4000.0),  # above the range
        event("B", 6, 10.0, sensors={"s2": None, "s3": 20.0}),
    ]
    got = {(r.engine_id, r.cycle): r.features for r in run(spark, str(tmp_path), [texts], window=2).collect()}
    assert set(got) == {("A", 2), ("A", 9), ("A", 10), ("B", 6)}
    assert got["A", 9][0] == np.float32(0.2) and got["A", 9][11] == np.float32(0.3)
    assert got["A", 10][11] == 1.0
    assert got["B", 6][0] == 0.0
    assert np.isnan(got["B", 6][11]) and got["B", 6][12] == 0.5 and got["B", 6][13] == 0.0
    sent = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], SCHEMA)
    assert sorted(r.arrival for r in events.dead_letters(sent).collect()) == [3, 4]


@pytest.mark.parametrize("size", [11, 1_000_000])
def test_stream_equals_batch_over_restarts(spark, tmp_path, size):
    rng = random.Random(7)
    texts = [event(f"E{rng.choice([0, 0, 0, 1, 2])}", max(1, i // 4 + rng.randint(-6, 6)), rng.uniform(0, 40)) for i in range(600)]
    batches = [texts[:100], texts[100:110], texts[110:400], texts[400:]]
    stream = run(spark, str(tmp_path), batches, window=10)
    sent = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], SCHEMA)
    batch = windows.arrival_frames(
        normalized_events(sent, LIMITS), "engine_id", ["arrival"], "cycle", "vector", 10, rows_per_slice=size
    )
    got = sorted((r.engine_id, r.cycle, tuple(r.features)) for r in stream.collect())
    want = sorted((r.engine_id, r.cycle, tuple(v for row in r.features for v in row)) for r in batch.collect())
    assert len(got) > 100 and got == want


def test_online_view_has_the_newest_vector(spark, tmp_path):
    root = str(tmp_path)
    batches = [[event("A", c, 1.0) for c in (1, 2, 3)] + [event("B", c, 2.0) for c in (1, 2)], [event("A", 4, 9.0)]]
    run(spark, root, batches, window=2, written_at=F.timestamp_millis("event_time"))

    def view(minute):
        as_of = F.timestamp_millis(F.lit(1_700_000_000_000 + minute * 60_000))
        return {r.engine_id: r.cycle for r in online_view(spark, f"{root}/online", as_of).collect()}

    assert view(4) == {"A": 4, "B": 2}
    assert view(62) == {"A": 4}
    assert view(64) == {}


def test_alert_stream_over_restarts(spark, tmp_path):
    steps = "aakaakkakaa"
    schema = "engine_id string, arrival bigint, risk_level string, failure_risk double, is_alert boolean, is_ack boolean"
    rows = [(e, i, "HIGH", 0.7, s == "a", s == "k") for e in ("E1", "E2") for i, s in enumerate(steps)]
    for lo, hi in ((0, 2), (2, 4), (4, 7), (7, 11)):
        spark.createDataFrame([r for r in rows if lo <= r[1] < hi], schema).write.mode("append").parquet(f"{tmp_path}/in")
        (
            opened_alerts(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"))
            .writeStream.format("parquet")
            .option("path", f"{tmp_path}/out")
            .option("checkpointLocation", f"{tmp_path}/cp")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    got = sorted((r.engine_id, r.arrival) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(e, i) for e in ("E1", "E2") for i in (0, 3, 7, 9)]


def test_drift_ticks_count_a_reading_once(spark, tmp_path):
    """Three micro-batches of 60 rows: the guard of 100 rows holds for the range; days come and go."""
    day = "timestamp_seconds(1704067200 + 86400 * {d})"
    reference = spark.range(300).select(F.col("id").cast("double").alias("s2"))
    counts = materialized(drift.value_counts(reference, ["s2"]), "reference")
    before = set(os.listdir(work_dir(spark)))
    sent = []
    for k, days in enumerate(([0, 1], [2, 0], [4, 3])):  # the second also brings late readings
        rows = spark.range(60).select(
            F.when(F.col("id") < 30, F.expr(day.format(d=days[0]))).otherwise(F.expr(day.format(d=days[1]))).alias("ts"),
            (F.col("id") + 250 + k).cast("double").alias("s2"),
        )
        rows.write.mode("append").parquet(f"{tmp_path}/in")
        sent.append(rows)
        stream = spark.readStream.schema("ts timestamp, s2 double").parquet(f"{tmp_path}/in")
        monitor_drift(stream, counts, f"{tmp_path}/drift", f"{tmp_path}/cp", 3, ["s2"], every=None).awaitTermination()

    assert set(os.listdir(work_dir(spark))) == before  # a tick leaves no intermediate tables

    def stored(name):
        rows = spark.read.option("basePath", f"{tmp_path}/drift/{name}").parquet(f"{tmp_path}/drift/{name}")
        return {r.batch: r for r in rows.collect()}

    assert {b: r.n_current for b, r in stored("report").items()} == {0: 60, 1: 120, 2: 90}  # days 2 to 4: 30 + 60
    assert {b: r.alert_level for b, r in stored("summary").items()} == {1: "CRITICAL"}
    last = sent[0].unionByName(sent[1]).unionByName(sent[2]).where("ts >= timestamp'2024-01-03 00:00:00'")
    assert stored("report")[2].statistic == drift.ks_report(reference, last, ["s2"]).first().statistic


def ticks_by_force(writes, interval, ttl, end):
    """(tick, engine, cycle) of all live engines at all ticks before ``end``."""
    found = []
    for k in range(1, 100):
        at = k * interval
        for engine in sorted({w[0] for w in writes}):
            seen = [w for w in writes if w[0] == engine and w[1] <= at]
            last = max(seen, key=lambda w: (w[1], w[2]), default=None)
            if at < end and last and last[1] > at - ttl:
                found.append((at, engine, last[3]))
    return found


def test_engines_leave_the_telemetry_by_a_timer(spark, tmp_path):
    """Deliveries over restarts; B falls silent and comes back, C sends once, ties and long gaps included."""
    minute = 60_000
    writes = [("A", t * minute, i, i) for i, t in enumerate((1, 4, 4, 9, 11, 19, 20, 21, 33, 47, 61, 62, 75))]
    writes += [("B", t * minute, 100 + t, t) for t in (2, 3, 40, 41, 70)] + [("C", 10 * minute, 200, 5)]
    root, schema = str(tmp_path), "engine_id string, written_at timestamp, arrival long, cycle long, event_time_ms long"
    for low, high in ((0, 5), (5, 12), (12, 45), (45, 99)):
        part = [w for w in writes if low * minute <= w[1] < high * minute]
        rows = spark.createDataFrame(part, "engine_id string, ms long, arrival long, cycle long")
        rows = rows.select("engine_id", F.timestamp_millis("ms").alias("written_at"), "arrival", "cycle", F.col("ms").alias("event_time_ms"))
        rows.write.mode("append").parquet(f"{root}/in")
        ticks = telemetry_ticks(spark.readStream.schema(schema).parquet(f"{root}/in"), 5 * minute, 12 * minute, "1 minute")
        (
            ticks.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/cp")
            .trigger(availableNow=True).start().awaitTermination()
        )
    got = sorted((r.tick_ms, r.engine_id, r.cycle) for r in spark.read.parquet(f"{root}/out").collect())
    want = ticks_by_force(writes, 5 * minute, 12 * minute, 74 * minute)
    assert got == want and {e for _, e, _ in want} == {"A", "B", "C"}
    assert not any(e == "C" and t > 22 * minute for t, e, _ in got)


def test_compacted_log(spark, tmp_path):
    """At most one snapshot and the batches after it are read; replays and broken compactions change nothing."""
    online, schema = str(tmp_path / "online"), "engine_id string, written_at int, cycle int, v int"

    def put(batch, *rows):
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{online}/batch={batch}")

    def view():
        return {r.engine_id: r.v for r in ordering.latest_per_key(featurelog.read_log(spark, online), ["engine_id"], ["written_at", "cycle"]).collect()}

    def listed():
        return [os.path.basename(p) for p in featurelog.current_folders(spark, online)]

    put(0, ("a", 1, 1, 10), ("b", 1, 1, 11))
    put(1, ("a", 2, 2, 20))
    os.makedirs(f"{online}/upto=1")  # broken off: no success mark
    assert listed() == ["batch=0", "batch=1"]
    featurelog.compact(spark, online, 1)
    featurelog.compact(spark, online, 1)
    assert listed() == ["upto=1"] and view() == {"a": 20, "b": 11}
    put(1, ("a", 2, 2, 20))  # the batch is replayed after its compaction
    put(2, ("c", 3, 1, 30))
    assert listed() == ["upto=1", "batch=2"] and view() == {"a": 20, "b": 11, "c": 30}
    put(3, ("b", 4, 2, 40))
    featurelog.compact(spark, online, 3)
    assert listed() == ["upto=3"] and view() == {"a": 20, "b": 40, "c": 30}
    assert sorted(n for n in os.listdir(online) if n.startswith(("batch", "upto"))) == ["batch=2", "batch=3", "upto=1", "upto=3"]
    featurelog.compact(spark, online, 1)  # an old compaction comes late
    assert listed() == ["upto=3"]
    with pytest.raises(FileNotFoundError):
        os.makedirs(f"{tmp_path}/none")
        featurelog.read_log(spark, f"{tmp_path}/none")


def test_offline_table_is_pruned_by_time(spark, tmp_path):
    root = str(tmp_path)
    run(spark, root, [[event("A", c, 1.0) for c in range(1, 90)], [event("A", c, 2.0) for c in range(90, 200)]], window=2)
    table = offline_table(spark, f"{root}/offline")
    hour = table.where("date = '2023-11-14' and hour = '23'")
    plan = hour._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2023-11-14" in plan
    assert hour.count() == 60 == len({r.cycle for r in hour.collect()})
    assert os.path.isdir(f"{root}/offline/date=2023-11-14/hour=23/batch=0")


def test_kafka_options():
    options = kafka.reader_options("h:1", group="g", max_per_trigger=200)
    assert options == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "telemetry.raw",
        "startingOffsets": "earliest",
        "kafka.group.id": "g",
        "maxOffsetsPerTrigger": "200",
    }


def test_engines_share_states(spark, tmp_path):
    """Python is called per bucket: the states of 60 engines are at most 4, and rows do not depend on their number."""
    texts = [event(f"E{i % 60}", i // 60 + 1, float(i % 37)) for i in range(360)]
    sent = [(i, t) for i, t in enumerate(texts)]
    columns = ["concat('E', id % 60) engine_id", "timestamp_millis(id * 1000) written_at", "id arrival", "id cycle", "id event_time_ms"]

    def both(buckets):
        root, found = f"{tmp_path}/{buckets}", {}
        for low, high in ((0, 150), (150, 360)):  # the second run goes on from the states of the first
            spark.createDataFrame(sent[low:high], SCHEMA).write.mode("append").parquet(f"{root}/messages")
            spark.range(low, high).selectExpr(*columns).write.mode("append").parquet(f"{root}/writes")
            messages = spark.readStream.schema(SCHEMA).parquet(f"{root}/messages")
            readings = spark.readStream.schema("engine_id string, written_at timestamp, arrival long, cycle long, event_time_ms long").parquet(f"{root}/writes")
            for name, rows in (
                ("features", rolling_features(normalized_events(messages, LIMITS), len(LIMITS), 3, buckets=buckets)),
                ("ticks", telemetry_ticks(readings, 20_000, 70_000, "1 second", buckets=buckets)),
            ):
                query = (
                    rows.writeStream.format("parquet").option("path", f"{root}/{name}")
                    .option("checkpointLocation", f"{root}/cp-{name}").trigger(availableNow=True).start()
                )
                query.awaitTermination()
                found[name] = query.recentProgress[0]["stateOperators"][0]["numRowsTotal"]
        assert all(0 < n <= buckets for n in found.values())
        return [sorted(map(str, spark.read.parquet(f"{root}/{name}").collect())) for name in found]

    few, many = both(4), both(1000)
    assert few == many and len(few[0]) == 60 * 4 and len(few[1]) > 300

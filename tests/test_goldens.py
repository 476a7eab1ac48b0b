"""Hand-checkable results."""

import math

import pytest
from pyspark.sql import functions as F

from vanewatch.functions import scalars
from vanewatch.functions.kolmogorov import ks_p_value
from vanewatch.operators import drift, evaluation, fleet, monitoring, ordering, prepare, quality, scoring, store
from vanewatch.spec import HISTOGRAM_BOUNDS, KEEP_SENSORS
from vanewatch.streaming.rules import interpolated


def column(spark, values, expr, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_risk_bands_and_rounding(spark):
    scores = [0.2999, 0.3, 0.6, 0.7996, 0.8]
    assert column(spark, scores, scalars.risk_band("x")) == ["LOW", "MEDIUM", "HIGH", "HIGH", "CRITICAL"]
    rows = spark.createDataFrame([("a", 1 - 0.7996), ("b", float("nan")), ("c", None), ("d", -0.1), ("e", 0.02)], "engine_id string, y double")

    def record(**options):
        df = scoring.prediction_records(rows, "y", F.lit("2024-01-01").cast("timestamp"), "v", **options)
        return {r.engine_id: r for r in df.collect()}

    plain, rounded = record(), record(band_on_rounded=True)
    assert (plain["a"].risk_level, rounded["a"].risk_level) == ("HIGH", "CRITICAL")
    assert plain["a"].failure_risk == 0.8
    assert (plain["b"].remaining_cycles, plain["b"].risk_level) == (0, "CRITICAL")
    assert plain["c"].remaining_cycles is None
    assert plain["d"].remaining_cycles == 0 and plain["d"].failure_risk == 1.0
    assert plain["e"].remaining_cycles == 2  # 2.5 rounds to even


def test_buckets_flags_and_clips_keep_missing_values(spark):
    values = [0.0, 30.0, 30.5, 125.0, 126.0]
    got = column(spark, values, scalars.rul_bucket("x"))
    assert got == [None, "critical(0-30)", "degrading(30-60)", "healthy(90-125)", None]
    assert column(spark, [29.9, 30.0], scalars.is_critical("x")) == [True, False]
    clipped = column(spark, [-1.0, 0.5, 2.0, None, float("nan")], scalars.clip_between("x", 0, 1))
    assert clipped[:4] == [0.0, 0.5, 1.0, None] and math.isnan(clipped[4])
    upper = column(spark, [200.0, None, float("nan")], scalars.clip_upper("x", 125))
    assert upper[:2] == [125.0, None] and math.isnan(upper[2])
    assert column(spark, [0.0, 0.05, 0.2], scalars.confidence("x")) == [1.0, 0.5, 0.0]


def test_label_of_a_long_life(spark):
    df = spark.range(1, 201).select(F.lit(1).alias("unit"), F.col("id").alias("cycle"))
    got = {r.cycle: r.RUL for r in prepare.add_rul(df).collect()}
    assert [got[c] for c in (1, 75, 76, 200)] == [125, 125, 124, 0]


def results(spark, pairs):
    rows = [(t, p) for (t, p), n in pairs.items() for _ in range(n)]
    return spark.createDataFrame(rows, "critical_true boolean, critical_pred boolean")


def test_classification_report(spark):
    pairs = {(False, False): 73, (False, True): 2, (True, False): 3, (True, True): 22}
    report = {r.label: r for r in evaluation.classification_report(results(spark, pairs)).collect()}
    critical, safe = report["Critical"], report["Non-Critical"]
    assert [round(v, 6) for v in critical[1:]] == [0.916667, 0.88, 0.897959, 25.0]
    assert [round(v, 6) for v in safe[1:4]] == [0.960526, 0.973333, 0.966887]
    assert report["accuracy"].f1_score == 0.95
    assert round(report["macro avg"].f1_score, 6) == 0.932423
    assert round(report["weighted avg"].f1_score, 6) == 0.949655


def test_report_with_one_class(spark):
    report = {r.label: r for r in evaluation.classification_report(results(spark, {(False, False): 4})).collect()}
    assert tuple(report["Critical"][1:]) == (0.0, 0.0, 0.0, 0.0)
    assert report["accuracy"].f1_score == 1.0
    cells = {(r.actual, r.predicted): r.n for r in evaluation.confusion(results(spark, {(False, False): 4})).collect()}
    assert cells == {(False, False): 4, (False, True): 0, (True, False): 0, (True, True): 0}


def test_penalty_gate_and_scoreboard(spark):
    df = spark.createDataFrame([(-13.0,), (0.0,), (10.0,)], "error double")
    assert round(df.agg(evaluation.penalty_score()).first()[0], 6) == 3.436564
    metrics = spark.createDataFrame([(70.0, 10000.0), (70.01, 1.0), (None, 1.0)], "rmse double, penalty_score double")
    assert [r.promote for r in evaluation.gate(metrics).collect()] == [True, False, False]
    one = spark.createDataFrame(
        [(14.9878, 449.632, 0.9167, 0.88, 0.898, 0.95, 0.9497)],
        "rmse double, penalty_score double, precision_critical double, recall_critical double, f1_critical double, accuracy double, f1_weighted double",
    )
    assert all(r.ok for r in evaluation.scoreboard(one).collect())
    shown = evaluation.summary(one).first()
    assert (shown.rmse, shown.penalty_score, shown.f1_weighted) == (14.99, 449.6, 0.95)


def test_histogram_and_spread(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 1, 9, 10)], "x double")
    bins = prepare.histogram(df, "x", 5).orderBy("bin").collect()
    assert [r.n for r in bins] == [3, 0, 0, 0, 2]
    same = prepare.histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x", 2).orderBy("bin").collect()
    assert [(r.bin_start, r.n) for r in same] == [(2.5, 0), (3.0, 2)]
    spread = prepare.column_spread(df.withColumn("flat", F.lit(1.0)), ["x", "flat"]).collect()
    assert {r.sensor for r in spread if r["drop"]} == {"flat"}


def test_fleet_levels_and_search(spark):
    rows = [("ENG-1", "LOW", 0.1), ("ENG-12", "HIGH", 0.7), ("ENG-2", "CRITICAL", 0.9), ("ENG-21", "odd", 0.95)]
    df = spark.createDataFrame(rows, "engine_id string, risk_level string, failure_risk double")
    assert [r.engine_id for r in fleet.alerts(df).collect()] == ["ENG-2", "ENG-12"]
    assert [r.engine_id for r in fleet.alerts(df, "nonsense").collect()] == ["ENG-2", "ENG-12"]
    assert fleet.alerts(df, "low").count() == 4  # an unknown row level ranks lowest
    assert [r.engine_id for r in fleet.search(df, "eng-1").collect()] == ["ENG-12", "ENG-1"]
    assert fleet.search(df, "ENG", "HIGH").count() == 1
    empty = df.where("false").withColumn("remaining_cycles", F.lit(1))
    assert tuple(fleet.fleet_kpi(empty).first()) == (0, 0, 0, 0)
    assert {r.engines for r in fleet.risk_distribution(empty).collect()} == {0}


@pytest.mark.parametrize("size", [2, 1000])
def test_alerts_open_once_until_acknowledged(spark, size):
    steps = "aakaakkaka"  # a = alert, k = acknowledgement
    rows = [("E1", i, s == "a", s == "k") for i, s in enumerate(steps)] + [("E2", 50, True, False), ("E2", 51, True, False)]
    log = spark.createDataFrame(rows, "engine_id string, seq int, is_alert boolean, is_ack boolean")
    got = fleet.deduplicated_alerts(log, ["seq"], rows_per_slice=size).collect()
    assert sorted((r.engine_id, r.seq, r.acknowledged) for r in got) == [
        ("E1", 0, True), ("E1", 3, True), ("E1", 7, True), ("E1", 9, False), ("E2", 50, False),
    ]


def test_store_expiry_and_status(spark):
    log = spark.createDataFrame(
        [("A", 0, 0, 1), ("A", 100, 1, 2), ("B", 10, 2, 9), ("C", 3700, 3, 4)],
        "engine_id string, t int, arrival int, cycle int",
    ).withColumn("written_at", F.timestamp_seconds(F.col("t") + 1_000_000))

    def active(second):
        as_of = F.timestamp_seconds(F.lit(1_000_000 + second))
        return {r.engine_id: r.cycle for r in store.latest_features(log, as_of).collect()}

    assert active(50) == {"A": 1, "B": 9}
    assert active(3609) == {"A": 2, "B": 9}
    assert active(3610) == {"A": 2}  # exactly the time to live has passed
    assert active(3700) == {"C": 4}
    frame = spark.createDataFrame
    status = store.engine_status(
        frame([("A",)], "engine_id string"),
        frame([("A", 2), ("B", 30), ("D", 29)], "engine_id string, buffered int"),
        frame([("B", 7), ("Z", 8)], "engine_id string, remaining_cycles int"),
    )
    got = {r.engine_id: (r.source, r.ready, r.last_prediction and r.last_prediction.remaining_cycles) for r in status.collect()}
    assert got == {"A": ("redis_stream", True, None), "B": ("push_buffer", True, 7), "D": ("push_buffer", False, None)}


def test_window_and_key_checks(spark):
    df = spark.createDataFrame(
        [("ok", [[1.0, 2.0]] * 3), ("short", [[1.0, 2.0]] * 2), ("narrow", [[1.0, 2.0], [1.0], [1.0, 2.0]])],
        "engine_id string, sensor_data array<array<double>>",
    )
    scored = scoring.score_or_error(df, [1 / 12] * 6, F.current_timestamp(), "v", 2, window=3).collect()
    got = {r.engine_id: (r.error, r.failure_risk) for r in scored}
    assert got["ok"] == (None, 0.25)
    assert got["short"] == ("Expected shape (3, 2), got (2, 2)", None)
    assert got["narrow"][1] is None and got["narrow"][0].startswith("Expected shape (3, 2)")
    log = spark.createDataFrame([({"s2": 1.0, "s3": 2.0},), ({"s2": 1.0},)], "reading map<string,double>")
    assert quality.accepted_readings(log, ["s2", "s3"]).count() == 1
    assert quality.rejected_readings(log, ["s2", "s3"]).first().missing == ["s3"]


def brute_ks(a, b):
    points = sorted(set(a) | set(b))
    return max(abs(sum(x <= p for x in a) / len(a) - sum(x <= p for x in b) / len(b)) for p in points)


@pytest.mark.parametrize("size", [5, 10_000])
def test_ks_matches_brute_force(spark, size):
    a = [float((i * 37) % 101) for i in range(150)]
    b = [float((i * 53) % 89 + 6) for i in range(120)]
    reference = spark.createDataFrame([(x, None) for x in a] + [(None, 1.0), (float("nan"), None)], "s2 double, s3 double")
    current = spark.createDataFrame([(x, None) for x in b], "s2 double, s3 double")
    report = drift.ks_report(reference, current, ["s2", "s3", "s9"], rows_per_slice=size).collect()
    assert [r.sensor for r in report] == ["s2"]  # s3 has an empty side, s9 is in neither
    assert (report[0].n_reference, report[0].n_current) == (150, 120)
    assert abs(report[0].statistic - brute_ks(a, b)) < 1e-12


def test_p_value_and_levels(spark):
    df = spark.createDataFrame([(0.0608,), (0.0728,), (0.0001,), (0.9,)], "d double")
    p = [r[0] for r in df.select(ks_p_value(F.col("d"), F.lit(1000), F.lit(1000))).collect()]
    assert [round(v, 4) for v in p] == [0.0476, 0.0094, 1.0, 0.0]
    levels = {}
    for n in (3, 4, 5, 6):
        report = spark.createDataFrame([(s, i < n) for i, s in enumerate(KEEP_SENSORS)], "sensor string, drifted boolean")
        one = drift.drift_summary(report, KEEP_SENSORS).first()
        levels[n] = (one.drift_share, one.alert_level, one.drift_detected)
    assert levels == {
        3: (0.2727, "OK", False), 4: (0.3636, "WARNING", True), 5: (0.4545, "WARNING", True), 6: (0.5455, "CRITICAL", True),
    }


def test_drift_guards(spark, tmp_path):
    wide = spark.range(200).select(F.col("id").cast("double").alias("s2"), F.lit(1.0).alias("s3"))
    nothing = wide.select(F.lit(1.0).alias("other"))
    one = drift.check_drift(wide, nothing).first()
    assert (one.alert_level, one.drift_share, one.total_features, one.missing_features) == ("ERROR", 0.0, 0, [])
    assert drift.check_drift(wide, wide.limit(99)).count() == 0
    moved = wide.withColumn("s2", F.col("s2") + 80)
    summary = drift.check_drift(wide, moved.drop("s3"))
    assert (summary.first().alert_level, summary.first().missing_features) == ("CRITICAL", ["s3"])
    report = drift.ks_report(wide, moved)
    when = F.lit("2024-05-01 10:00:00").cast("timestamp")
    for tick in (7, 8, 8):  # the last one is a replay
        drift.append_report(report, summary, when, tick, str(tmp_path / "reports"))
    drift.append_report(*drift.report_and_summary(wide, wide), when, 9, str(tmp_path / "reports"))
    assert sorted(r.tick for r in spark.read.parquet(str(tmp_path / "reports")).collect()) == [7, 7, 8, 8]


def test_counter_resets(spark):
    rows = [("a", i * 20, v) for i, v in enumerate([5, 7, 7, 2, 3])] + [("b", 0, 9)]
    df = spark.createDataFrame(rows, "s string, t int, value int").withColumn("ts", F.timestamp_seconds("t"))
    for size in (2, 1000):
        got = monitoring.counter_increase(df, ["s"], ["ts"], rows_per_slice=size).orderBy("s", "t").collect()
        assert [r.increase for r in got] == [None, 2, 0, 2, 1, None]
    rate = monitoring.counter_rate(df, ["s"], ["ts"], "value", 60).orderBy("s", "window_start").collect()
    assert [round(r.rate * 60, 9) for r in rate] == [2.0, 3.0, 0.0]


def test_histogram_quantile_edges(spark):
    def quantile(values, q, bounds):
        df = spark.createDataFrame([(float(v),) for v in values], "x double")
        buckets = monitoring.histogram_buckets(df, "x", bounds)
        return monitoring.histogram_quantile(buckets, q).first()[0]

    bounds = HISTOGRAM_BOUNDS["prediction_latency_seconds"]
    assert quantile([0.02] * 10, 0.5, bounds) == pytest.approx(0.0175)
    assert quantile([5.0] * 10, 0.5, bounds) == 1.0  # beyond the last finite bound
    assert quantile([0.0] * 4, 0.5, HISTOGRAM_BOUNDS["failure_risk_score"]) == 0.0
    assert quantile([0.0005] * 4, 0.5, bounds) == pytest.approx(0.0005)
    empty = spark.createDataFrame([(None,)], "x double")
    assert monitoring.histogram_quantile(monitoring.histogram_buckets(empty, "x", bounds), 0.5).first()[0] is None


@pytest.mark.parametrize("size", [2, 1000])
def test_rule_on_histogram_counters(spark, size):
    """Two servers with counters per bound; one restarts in between; the quantile stays high for two minutes."""
    rows = []
    # per minute: requests up to 0.1 s, and all of them
    for server, counts in (("a", [(0, 0), (6, 10), (12, 20), (32, 40)]), ("b", [(50, 90), (52, 95), (1, 5), (41, 45)])):
        for t, (low, high) in enumerate(counts):
            rows += [(server, t, 0.1, low), (server, t, 0.2, high), (server, t, math.inf, high)]
    df = spark.createDataFrame(rows, "server string, t int, le double, value int").withColumn("ts", F.timestamp_seconds(F.col("t") * 60))
    held = monitoring.quantile_rule(df, [], ["server"], ["ts"], 0.75, 0.1, 120, 60, rows_per_slice=size).collect()
    # minute 1: 8 of 15 up to 0.1; minute 2: 7 of 15 (after the restart 1 of 5); minute 3: 60 of 60
    assert [(r.windows, (r.until - r.since).total_seconds()) for r in held] == [(2, 120)]
    assert held[0].peak == pytest.approx(0.1 + 0.1 * (0.75 * 15 - 7) / 8)
    assert monitoring.quantile_rule(df, [], ["server"], ["ts"], 0.75, 0.1, 180, 60).count() == 0


def test_quantile_from_counts_side_by_side(spark):
    """As the long form gives it, edges included."""
    cases = [([0, 0, 0], 0.5), ([0, 5, 5], 0.5), ([2, 5, 9], 0.9), ([5, 5, 5], 0.2), ([0, 0, 4], 0.5), ([3, 3, 4], 0.0), ([1, 4, 4], 1.0)]
    for bounds in ([0.1, 0.5], [0.0, 0.5]):
        for i, (counts, q) in enumerate(cases):
            wide = spark.createDataFrame([tuple(counts)], "a long, b long, c long")
            rows = list(zip([*bounds, math.inf], counts, strict=True))
            long = monitoring.histogram_quantile(spark.createDataFrame(rows, "le double, cumulative long"), q).first()[0]
            assert wide.select(interpolated([F.col(c) for c in "abc"], bounds, q)).first()[0] == (long if long is None else pytest.approx(long)), i


def test_sketches_of_hours_merge(spark):
    """Ranks of merged sketches are off by less than one percent, however uneven the hours are."""
    rows = spark.range(60_000).select(
        F.timestamp_seconds(F.col("id") * F.col("id") / 20_000).alias("ts"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"),
        F.when(F.col("id") % 1000 != 1, F.pmod(F.col("id") * 7919, F.lit(60_000)) ** 1.5).alias("v"),
    )
    sketches = monitoring.hourly_sketches(rows, "v", "ts", ["g"])
    assert sketches.count() > 50
    for r in monitoring.merged_quantiles(sketches, {"p05": 0.05, "p50": 0.5, "p99": 0.99}, ["g"]).collect():
        values = sorted(x.v for x in rows.where((F.col("g") == r.g) & F.col("v").isNotNull()).select("v").collect())
        assert r.n == len(values)
        for q, got in ((0.05, r.p05), (0.5, r.p50), (0.99, r.p99)):
            assert abs(sum(v <= got for v in values) / len(values) - q) < 0.01


def test_batch_scores_of_misfit_windows(spark):
    """Lengths count over all rows of a window; missing values give NaN, missing windows and rows NULL or less."""
    windows = [
        [[1.0, 2.0], [3.0, 4.0]], None, [], [[1.0, 2.0]], [[1.0], [2.0, 3.0, 4.0]], [[1.0, None], [3.0, 4.0]], [None, [1.0, 2.0, 3.0, 4.0]],
        [[1.0, 2.0], [3.0, 4.0], []], [None],
    ]
    df = spark.createDataFrame(list(enumerate(windows)), "i int, w array<array<float>>").coalesce(1)
    y = scoring.batch_score("w", [1.0, 10.0, 100.0, 1000.0], 0.5)
    for some in (df, df.where("i >= 3"), df.where("i in (0, 4)"), df.where("i in (1, 2)")):
        got = {r.i: r.y for r in some.select("i", y.alias("y")).collect()}
        want = {0: 4321.5, 4: 4321.5, 6: 4321.5, 7: 4321.5}
        for i, value in got.items():
            assert math.isnan(value) if i == 5 else value == want.get(i), i


def test_silence_between_and_at_the_ends(spark):
    rows = [("a", 0), ("a", 1), ("a", 5), ("b", 3), ("c", 0), ("c", 7), ("d", 7)]
    df = spark.createDataFrame(rows, "s string, m int").withColumn("ts", F.timestamp_seconds(F.col("m") * 60 + 7))
    silent = monitoring.silent_windows(df, "ts", "1 minute", ["s"])
    got = {(r.s, r.m) for r in silent.select("s", (F.unix_seconds("window_start") / 60).cast("int").alias("m")).collect()}
    assert got == {(s, m) for s in "abcd" for m in range(8)} - set(rows)
    assert "Cartesian" not in silent._jdf.queryExecution().executedPlan().toString()
    assert sorted(r[0].minute for r in monitoring.silent_windows(df.where("s = 'a'"), "ts", "1 minute").collect()) == [2, 3, 4]


def test_scaling_by_constants(spark):
    df = spark.createDataFrame([(5.0, 3.0), (-1.0, 3.0), (99.0, 4.0)], "s2 double, s3 double")
    got = prepare.minmax_apply_constants(df, {"s2": (0.0, 10.0), "s3": (3.0, 3.0)}).collect()
    assert [tuple(r) for r in got] == [(0.5, 0.0), (0.0, 0.0), (1.0, 1.0)]


@pytest.mark.parametrize("size", [3, 1000])
def test_exact_quantiles(spark, size):
    values = [float((i * 7) % 23) for i in range(40)]
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    ordered = sorted(values)

    def want(q):
        place = q * 39
        low = ordered[math.floor(place)]
        return low + (ordered[math.ceil(place)] - low) * (place - math.floor(place))

    qs = {"a": 0.0, "b": 0.5, "c": 0.95, "d": 1.0}
    got = monitoring.exact_quantiles(df, "v", qs, ["g"], rows_per_slice=size).first()
    assert [got[n] for n in qs] == pytest.approx([want(q) for q in qs.values()])
    whole = monitoring.exact_quantiles(df, "v", {"b": 0.5}, rows_per_slice=size).first()
    assert whole.b == pytest.approx(want(0.5))


def test_sustained_gaps_and_silence(spark):
    minutes = [0, 1, 2, 4, 5, 9]
    df = spark.createDataFrame([(m * 60,) for m in minutes], "t int").withColumn("ts", F.timestamp_seconds("t"))
    silent = monitoring.silent_windows(df, "ts", "1 minute")
    assert sorted(r.window_start.minute for r in silent.collect()) == [3, 6, 7, 8]
    rates = monitoring.default_zero(
        monitoring.time_spine(df, "ts", "1 minute"), monitoring.throughput(df, "ts", 60), "rate"
    )
    assert rates.count() == 10
    held = monitoring.sustained(rates, F.col("rate") > 0, 120, 60).orderBy("since").collect()
    assert [(r.since.minute, r.until.minute, r.windows) for r in held] == [(0, 3, 3), (4, 6, 2)]


def test_gauges(spark):
    rows = [(1, "i", "used", 50.0), (1, "i", "max", 200.0), (2, "i", "used", 5.0), (2, "i", "max", 0.0), (3, "i", "used", 1.0)]
    df = spark.createDataFrame(rows, "ts int, instance string, metric string, value double")
    got = {r.ts: r.percent for r in monitoring.gauge_ratio(df, "used", "max").collect()}
    assert got == {1: 25.0, 2: None}
    assert monitoring.above(monitoring.gauge_ratio(df, "used", "max"), 20.0).first().firing


def test_latest_keeps_last_write(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 3, 20), ("a", 2, 30), ("b", 1, None)], "k string, t int, v int")
    assert {r.k: r.v for r in ordering.latest_per_key(df, ["k"], ["t"]).collect()} == {"a": 20, "b": None}
    values = prepare.last_values(df.withColumn("v", F.when(F.col("t") < 3, F.col("v"))), "k", "t", ["v"])
    assert {r.k: r.v for r in values.collect()} == {"a": 30, "b": None}

"""Text files through all batch stages, and the faults that must stop them."""

import json
import random

import pytest
from pyspark.sql import functions as F

from vanewatch.operators import prepare, quality, windows
from vanewatch.plans import jobs
from vanewatch.sources import tables, text
from vanewatch.spec import DROP_COLUMNS, KEEP_SENSORS, RAW_COLUMNS


def fleet(units, seed, cut=0):
    """Lines of a run-to-failure fleet; sensors drift with age."""
    rng = random.Random(seed)
    out = []
    for unit in range(1, units + 1):
        life = rng.randint(40, 90)
        for cycle in range(1, life - (cut and rng.randint(1, cut)) + 1):
            age = cycle / life
            sensors = [
                f"{600 + i + (age * 5 * i + rng.random() if f's{i}' in KEEP_SENSORS else 0):.4f}" for i in range(1, 22)
            ]
            out.append(" ".join([str(unit), str(cycle), "0.001", "0.0002", "100.0", *sensors]) + "  ")
    return out


@pytest.fixture
def files(tmp_path):
    train, test = fleet(14, 1), fleet(9, 2, cut=35)
    rul = [f"{random.Random(i).randint(0, 140)} " for i in range(9)]
    paths = {}
    for name, lines in (("train_a.txt", train), ("test_a.txt", test), ("RUL_a.txt", rul)):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        paths[name] = str(tmp_path / name)
    return paths, train, test, rul


def job_for(files, tmp_path):
    paths = files[0]
    return jobs.Job(paths["train_a.txt"], paths["test_a.txt"], paths["RUL_a.txt"], str(tmp_path / "out"), epochs=20)


def test_all_stages(spark, files, tmp_path):
    _, train, test, rul = files
    job = job_for(files, tmp_path)
    jobs.run(spark, job)

    silver = spark.read.parquet(job.at("silver/train"))
    assert set(silver.columns) == set(RAW_COLUMNS) - set(DROP_COLUMNS) | {"RUL"}
    assert silver.count() == len(train)
    span = silver.agg(*[F.min(s).alias(f"a{s}") for s in KEEP_SENSORS], *[F.max(s).alias(f"b{s}") for s in KEEP_SENSORS]).first()
    assert all(abs(span[f"a{s}"]) < 1e-6 and abs(span[f"b{s}"] - 1) < 1e-6 for s in KEEP_SENSORS)

    final = {r.unit: r.RUL for r in spark.read.parquet(job.at("silver/test")).select("unit", "RUL").distinct().collect()}
    assert final == {i + 1: int(v) for i, v in enumerate(rul)}

    gold = spark.read.parquet(job.at("gold"))
    counts = {r.split: r["count"] for r in gold.groupBy("split").count().collect()}
    lives = silver.groupBy("unit").count().collect()
    assert counts["train"] + counts["validation"] == sum(r["count"] - 29 for r in lives)
    assert counts["test"] == 9
    both = {
        s: {r.unit for r in gold.where(F.col("split") == s).select("unit").distinct().collect()}
        for s in ("train", "validation")
    }
    assert not both["train"] & both["validation"]
    assert len(both["validation"]) == 3  # ceil(0.2 * 14)
    assert gold.where((F.size("features") != 30) | (F.size(F.flatten("features")) != 330)).count() == 0

    status = spark.read.json(job.at("validation/status")).first()
    assert status.status == "passed" and status.files == 3
    assert {r.name for r in spark.read.parquet(job.at("validation/files")).collect()} == {"RUL", "test", "train"}
    metrics = spark.read.json(job.at("evaluation/metrics")).first()
    assert 0 < metrics.rmse < 70
    history = tables.read_history(spark, job.at("history"))
    loss = history.first().history["loss"]
    assert len(loss) > 1 and loss[-1] <= loss[0]
    limits = spark.read.json(job.at("scaler/config")).first()
    assert limits.sensors == list(KEEP_SENSORS) and limits.n_sensors == 11 and len(limits.data_min) == 11
    assert spark.read.parquet(job.at("evaluation/gate")).first().promote
    assert (tmp_path / "out/registry/production").exists()


def test_restart(spark, files, tmp_path, monkeypatch):
    """A stage that failed is done again with all after it; settings, inputs and outputs are compared."""
    job = job_for(files, tmp_path)
    every = [work.__name__ for work, _, _ in jobs.STAGES]

    def broken(*_):
        raise RuntimeError("lost")

    stages = list(jobs.STAGES)
    monkeypatch.setattr(jobs, "STAGES", [(w if w.__name__ != "transform" else broken_stage(broken), r, o) for w, r, o in stages])
    with pytest.raises(RuntimeError, match="lost"):
        jobs.run(spark, job, "features")
    monkeypatch.setattr(jobs, "STAGES", stages)
    assert jobs.run(spark, job, "features") == ["transform", "features"]
    assert jobs.run(spark, job, "features") == []
    shorter = jobs.Job(job.train, job.test, job.rul, job.out, window=20)
    assert jobs.run(spark, shorter, "features") == every[:4]
    with open(files[0]["train_a.txt"], "a") as f:
        f.write(files[1][-1].replace("14 ", "15 ", 1) + "\n")
    assert jobs.run(spark, shorter, "validate") == every[:2]
    next((tmp_path / "out/validation/report").glob("part*")).unlink()
    assert jobs.run(spark, shorter, "features") == every[1:4]


def broken_stage(work):
    work.__name__ = "transform"
    return work


def test_landing_keeps_what_is_there(spark, files, tmp_path):
    job = job_for(files, tmp_path)
    jobs.ingest(spark, job)
    before = text.read_lines(spark, job.at("bronze/train")).count()
    with open(files[0]["train_a.txt"], "a") as f:
        f.write("1 1 0 0 0\n")
    jobs.ingest(spark, job)
    assert text.read_lines(spark, job.at("bronze/train")).count() == before


def validate(spark, tmp_path, name, lines):
    (tmp_path / name).write_text("\n".join(lines) + "\n")
    report = quality.validate_files(text.read_lines(spark, str(tmp_path), "*.txt"))
    return {r.rule: r.violations for r in report.collect()}, quality.validation_status(report).first()


@pytest.mark.parametrize("max_bytes", ["128m", "3k"])
def test_faults_are_counted_in_any_split(spark, tmp_path, max_bytes):
    lines = fleet(4, 5)
    spark.conf.set("spark.sql.files.maxPartitionBytes", max_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        counts, status = validate(spark, tmp_path, "train.txt", lines)
        assert counts == {"column_count": 0, "numeric": 0, "monotonic_cycle": 0}
        assert status.status == "passed" and status.files == 1

        broken = list(lines)
        broken[3] = " ".join(broken[3].split()[:25])
        broken[7] = broken[7].replace(" 100.0 ", " hundred ")
        broken[20], broken[21] = broken[21], broken[20]
        broken[30] = broken[29]  # an equal neighbour is fine
        counts, status = validate(spark, tmp_path, "train.txt", broken)
        assert counts == {"column_count": 1, "numeric": 1, "monotonic_cycle": 1}
        assert status.status == "failed" and status.error == "train.txt: column_count has 1 violations"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_rul_files_and_missing_files(spark, tmp_path):
    counts, status = validate(spark, tmp_path, "my_rul.txt", ["12 ", "0", "-1", "4 4", "x"])
    assert counts == {"column_count": 1, "numeric": 1, "non_negative": 1}
    assert status.status == "failed"
    empty = tmp_path / "none"
    empty.mkdir()
    report = quality.validate_files(text.read_lines(spark, str(empty), "*.txt"))
    assert quality.validation_status(report).first().error == "no data files found"


def test_invalid_input_stops_the_job(spark, files, tmp_path):
    with open(files[0]["RUL_a.txt"], "a") as f:
        f.write("-3\n")
    job = job_for(files, tmp_path)
    with pytest.raises(ValueError, match="RUL: non_negative"):
        jobs.run(spark, job)
    assert json.loads(next((tmp_path / "out/validation/status").glob("*.json")).read_text())["status"] == "failed"
    assert not (tmp_path / "out/silver").exists()


def test_positions_survive_small_splits(spark, tmp_path):
    path = tmp_path / "rul.txt"
    path.write_text("\n".join(f"{i * 7} " + ("\n" if i % 5 == 0 else "") for i in range(1, 400)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = text.read_rul(spark, str(path))
        got = {r.pos: r.RUL for r in lines.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {i: i * 7 for i in range(1, 400)}


@pytest.mark.parametrize("extra", [-1, 1])
def test_positional_count_mismatch_raises(spark, extra):
    units = spark.range(5).select(F.col("id").alias("unit"))
    values = spark.range(1, 6 + extra).select(F.col("id").alias("pos"), F.lit(1).alias("RUL"))
    with pytest.raises(Exception, match="differs from the number of units"):
        prepare.attach_positional(values, units).collect()


@pytest.mark.parametrize("size", [3, 1000])
def test_attach_and_split_with_small_slices(spark, size):
    units = spark.createDataFrame([(u,) for u in (90, 3, 3, 40, 7, 1000, 5)], "unit bigint")
    values = spark.range(1, 7).select(F.col("id").alias("pos"), (F.col("id") * 10).alias("RUL"))
    got = {r.unit: r.RUL for r in prepare.attach_positional(values, units, rows_per_slice=size).collect()}
    assert got == {3: 10, 5: 20, 7: 30, 40: 40, 90: 50, 1000: 60}
    split = prepare.split_units(spark.range(37).withColumnRenamed("id", "unit"), rows_per_slice=size)
    chosen = {r.unit for r in split.where("is_validation").collect()}
    again = prepare.split_units(spark.range(37).withColumnRenamed("id", "unit"))
    assert len(chosen) == 8 and chosen == {r.unit for r in again.where("is_validation").collect()}


def test_scaler_export_checks_the_feature_list(spark, tmp_path):
    params = spark.createDataFrame([("s2", 1.0, 2.0), ("s3", 0.123456789, 5.0)], "sensor string, mn double, mx double")
    tables.write_scaler(params, str(tmp_path / "ok"), ["s2", "s3"], 30, 125)
    rows = {r.sensor: r.mn for r in tables.read_scaler(spark, str(tmp_path / "ok")).collect()}
    assert rows == {"s2": 1.0, "s3": 0.12345679}
    with pytest.raises(ValueError):
        tables.write_scaler(params, str(tmp_path / "short"), ["s2", "s3", "s4"], 30, 125)
    with pytest.raises(Exception, match="no feature s3"):
        tables.write_scaler(params, str(tmp_path / "extra"), ["s2", "s9"], 30, 125)


@pytest.mark.parametrize("size", [30, 33, 1_000_000])
def test_window_counts_and_padding(spark, size):
    rows = [(u, c, float(u * 1000 + c)) for u, n in ((1, 29), (2, 30), (3, 35), (4, 300)) for c in range(1, n + 1)]
    df = spark.createDataFrame(rows, "unit int, cycle int, x double").select(
        "unit", (F.col("cycle") * 3).alias("cycle"), F.array(F.col("x").cast("float")).alias("row")
    )
    frames = windows.sliding_frames(df, "unit", ["cycle"], "row", rows_per_slice=size).collect()
    counts = {u: sum(r.unit == u for r in frames) for u in (1, 2, 3, 4)}
    assert counts == {1: 0, 2: 1, 3: 6, 4: 271}
    for r in frames:
        end = r.cycle // 3
        assert [v[0] for v in r.features] == [r.unit * 1000 + c for c in range(end - 29, end + 1)]
    last = {r.unit: r for r in windows.last_frames(df, "unit", ["cycle"], "row", 1).collect()}
    assert [v[0] for v in last[1].features] == [0.0] + [1000.0 + c for c in range(1, 30)]
    assert last[1].n_rows == 29 and last[4].features[-1][0] == 4300.0


def test_bad_tokens_are_counted_by_one_cast(spark):
    """Words, empty tokens and odd numbers count as before, without a function that is called for each token."""
    tokens = [["1", "x", "", "2.5"], ["NaN", "Infinity", "1e3", "-"], [], ["1_0", None, " 7 ", "0x1"]]
    rows = spark.createDataFrame([(t,) for t in tokens], "tokens array<string>")
    one_by_one = F.size(F.filter("tokens", lambda t: t.try_cast("double").isNull()))
    got = rows.select(quality._bad_tokens().alias("n"), one_by_one.alias("m")).collect()
    assert [r.n for r in got] == [r.m for r in got] and got[0].n == 2
    assert "lambda" not in rows.select(quality._bad_tokens())._jdf.queryExecution().analyzed().toString().split("array_compact")[0]


def test_transform_parses_a_line_once(spark, files, tmp_path, monkeypatch):
    """Limits, lifetimes and the silver tables read stored rows; each landed file is parsed by one plan."""
    written = []
    kept = jobs.materialized
    monkeypatch.setattr(jobs, "materialized", lambda df, name="step", **more: written.append(name) or kept(df, name, **more))
    job = job_for(files, tmp_path)
    jobs.run(spark, job, "transform")
    assert written == ["parsed", "parsed"]
    assert spark.read.parquet(job.at("silver/train")).count() == len(files[1])

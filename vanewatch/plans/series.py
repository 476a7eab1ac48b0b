"""Queries over raw series: preparation, windows, sources, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewatch.functions import scalars
from vanewatch.functions.vectors import normalized_vector, sensor_row
from vanewatch.operators import prepare, quality, windows
from vanewatch.operators.ordering import latest_per_key, with_ordinal
from vanewatch.plans.registry import query
from vanewatch.plans.testviews import MIDDLE, events, messages, ntz, raw_tokens, sql, table, telemetry
from vanewatch.session import fresh_dir, materialized
from vanewatch.sources import events as event_source
from vanewatch.sources import tables, text
from vanewatch.spec import DROP_COLUMNS, KEEP_SENSORS, RAW_COLUMNS, SENSORS, WINDOW

CLIP = 60  # the supplied series are short; a lower limit makes the clip visible
WIDTH = len(KEEP_SENSORS)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in columns})


def _rounds(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) as {c}" for c in columns)


# --- labels and scaling --------------------------------------------------------------------------

RUL = f"select *, max(cycle) over (partition by unit) as max_cycle, " \
      f"cast(least(max(cycle) over (partition by unit) - cycle, {CLIP}) as double) as rul from t"


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.add_rul(telemetry(spark, sf_dir), clip=CLIP, out="rul")


@query("virtual_ordinal", sql("select unit, event_id, cycle from t", "t"))
def virtual_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(spark, sf_dir).select("unit", "event_id", "cycle")


@query("rul_label", sql("select unit, cycle, max_cycle, rul from r", "t", r=RUL))
def rul_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).select("unit", "cycle", "max_cycle", "rul")


@query(
    "training_targets",
    sql(
        f"select unit, cycle, round(rul / {CLIP}.0, 6) as y, round(1 + 1.5 * (rul / {CLIP}.0), 6) as weight, "
        f"round(1 + 1.5 * (1 - rul / {CLIP}.0), 6) as weight_late, round(rul, 6) as restored from r",
        "t",
        r=RUL,
    ),
)
def training_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = scalars.normalized_target("rul", CLIP)
    rows = labelled(spark, sf_dir).select(
        "unit",
        "cycle",
        y.alias("y"),
        scalars.sample_weight(y).alias("weight"),
        scalars.sample_weight(y, late_life=True).alias("weight_late"),
        scalars.denormalized_target(y, CLIP).alias("restored"),
    )
    return rounded(rows, "y", "weight", "weight_late", "restored")


def train_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("ts") < ntz(MIDDLE))


FITTED = ("s1", *KEEP_SENSORS)
FIT = " union all ".join(
    f"select '{s}' as sensor, min({s}) as mn, max({s}) as mx from t where ts < timestamp '{MIDDLE}'" for s in FITTED
)


@query("minmax_fit", sql("select * from f", "t", f=FIT))
def minmax_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.minmax_fit(train_rows(telemetry(spark, sf_dir)), FITTED)


def _sql_scaled(s: str) -> str:
    lo, hi = (f"(select {x} from f where sensor = '{s}')" for x in ("mn", "mx"))
    return f"round(({s} - {lo}) / case when {hi} - {lo} = 0 then 1 else {hi} - {lo} end, 6) as {s}"


@query("minmax_batch", sql(f"select unit, cycle, {', '.join(map(_sql_scaled, FITTED))} from t", "t", f=FIT))
def minmax_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = telemetry(spark, sf_dir)
    params = prepare.minmax_fit(train_rows(rows), FITTED)
    scaled = prepare.minmax_apply(rows.select("unit", "cycle", *FITTED), params, FITTED)
    return rounded(scaled, *FITTED)


# Constant limits of a stream job: s2 leaves the range on both sides, s4 has none.
LIMITS = {s: (50.0, 50.0 + 40.0 * int(s[1:])) for s in KEEP_SENSORS} | {"s4": (80.0, 80.0)}


def _sql_clamped(s: str) -> str:
    lo, hi = LIMITS[s]
    raw = "cast(0 as real)" if s == "s21" else f"cast({s} as real)"
    spread = f"(cast({hi} as real) - cast({lo} as real))"
    scaled = f"({raw} - cast({lo} as real)) / case when {spread} = 0 then cast(1 as real) else {spread} end"
    return f"cast(greatest(0, least(1, {scaled})) as real)"


CLAMPED = f"select *, [{', '.join(_sql_clamped(s) for s in KEEP_SENSORS)}] as vec from m"


@query(
    "minmax_clamped",
    sql(
        "select engine_id, cycle, "
        + ", ".join(f"round(cast(vec[{i + 1}] as double), 6) as {s}" for i, s in enumerate(KEEP_SENSORS))
        + " from c",
        "m",
        c=CLAMPED,
    ),
)
def minmax_clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = event_source.decode(messages(spark, sf_dir))
    vector = decoded.select(
        "engine_id", F.col("cycle").cast("bigint").alias("cycle"), normalized_vector("sensors", LIMITS).alias("v")
    )
    return rounded(
        vector.select("engine_id", "cycle", *[F.col("v")[i].alias(s) for i, s in enumerate(KEEP_SENSORS)]),
        *KEEP_SENSORS,
    )


@query(
    "low_variance_columns",
    sql(
        " union all ".join(
            f"select '{s}' as sensor, round(stddev_samp({s}), 6) as std, stddev_samp({s}) < 0.01 as drop from t"
            for s in SENSORS
        ),
        "t",
    ),
)
def low_variance_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(prepare.column_spread(telemetry(spark, sf_dir), SENSORS), "std")


@query(
    "silver_train",
    sql(
        f"select unit, cycle, {_rounds('os1', 'os2')}, {', '.join(map(_sql_scaled, KEEP_SENSORS))}, rul as RUL from r",
        "t",
        f=FIT,
        r=RUL,
    ),
)
def silver_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional names, dropped columns, sensors found by prefix, scaled, labelled."""
    rows = telemetry(spark, sf_dir)
    anonymous = rows.select(*RAW_COLUMNS).toDF(*[f"_c{i}" for i in range(len(RAW_COLUMNS))])
    slim = prepare.drop_unused(prepare.rename_positional(anonymous), DROP_COLUMNS)
    sensors = prepare.feature_columns(slim)
    params = prepare.minmax_fit(train_rows(rows), sensors)
    labelled_rows = prepare.add_rul(prepare.minmax_apply(slim, params, sensors), clip=CLIP)
    return rounded(labelled_rows.drop("max_cycle"), "os1", "os2", *sensors)


@query(
    "lifespan_stats",
    sql(
        "select count(*) as units, min(n) as min_life, max(n) as max_life, round(avg(n), 6) as mean_life "
        "from (select unit, max(cycle) as n from t group by unit)",
        "t",
    ),
)
def lifespan_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(prepare.lifespan_stats(telemetry(spark, sf_dir)), "mean_life")


def sql_histogram(source: str, column: str, bins: int) -> str:
    return (
        f"select b as bin, round(lo + b * (hi - lo) / {bins}, 6) as bin_start, "
        f"round(lo + (b + 1) * (hi - lo) / {bins}, 6) as bin_end, count(x) as n "
        f"from (select min({column}) as lo, max({column}) as hi from {source}) s, "
        f"(select unnest(range({bins})) as b) g left join "
        f"(select {column} as x, least(cast(floor(({column} - (select min({column}) from {source})) * {bins} / "
        f"((select max({column}) from {source}) - (select min({column}) from {source}))) as bigint), {bins - 1}) as xb "
        f"from {source}) v on v.xb = g.b group by b, lo, hi"
    )


@query(
    "lifespan_histogram",
    sql(sql_histogram("life", "n", 20), "t", life="select cast(max(cycle) as double) as n from t group by unit"),
)
def lifespan_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    lives = prepare.lifetimes(telemetry(spark, sf_dir))
    return rounded(prepare.histogram(lives, "max_cycle", 20), "bin_start", "bin_end")


# --- positional values, joins, split -------------------------------------------------------------

# The i-th engine to report, in time order, gives the i-th value of the list.
FINAL = (
    "select row_number() over (order by ts, event_id) as pos, cast(k as integer) as rul from "
    "(select *, row_number() over (partition by user_id order by ts, event_id) as rn from e) where rn = 1"
)
UNITS = "select unit, row_number() over (order by unit) as pos from (select distinct unit from t)"


def final_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = events(spark, sf_dir).groupBy("user_id").agg(
        F.min_by(F.struct("ts", "event_id", "k"), F.struct("ts", "event_id")).alias("f")
    )
    return with_ordinal(first.select("f.*"), [], ["ts", "event_id"], "pos")


def final_rul(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = final_values(spark, sf_dir).select("pos", F.col("k").cast("int").alias("rul"))
    units = events(spark, sf_dir).select(F.col("user_id").alias("unit"))
    return prepare.attach_positional(values, units)


@query("positional_attach", sql("select unit, pos, rul from u join v using (pos)", "t", u=UNITS, v=FINAL))
def positional_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return final_rul(spark, sf_dir).select("unit", "pos", "rul")


@query(
    "test_rul_left_join",
    sql("select unit, cycle, rul from t left join (select unit, rul from u join v using (pos)) using (unit)",
        "t", u=UNITS, v=FINAL),
)
def test_rul_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = telemetry(spark, sf_dir).select("unit", "cycle")
    return prepare.join_final_rul(rows, final_rul(spark, sf_dir).select("unit", "rul"))


@query(
    "rul_file_scan",
    sql("select pos, rul as RUL from v", "e", v=FINAL),
)
def rul_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list written as a text file with trailing blanks, read back by line position."""
    path = fresh_dir(spark, "rul")
    lines = final_values(spark, sf_dir).orderBy("pos")
    lines.select(F.concat(F.col("k").cast("int").cast("string"), F.lit(" "))).write.text(path)
    return text.read_rul(spark, path)


@query("landed_rul_files", sql("select pos, rul as RUL from v", "e", v=FINAL))
def landed_rul_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list in files of unequal size, landed: the order of lines holds over files and copies."""
    path = fresh_dir(spark, "landing")
    lines = final_values(spark, sf_dir)
    lines = materialized(lines.select("pos", F.col("k").cast("int").cast("string").alias("value")), "lines")
    for name, low, high in (("a", 0, 3), ("b", 3, 53), ("c", 53, 1 << 60)):
        part = lines.where((F.col("pos") > low) & (F.col("pos") <= high)).orderBy("pos")
        part.select("value").write.text(f"{path}/source/{name}")
    return text.rul_rows(text.land(spark, f"{path}/source/*", f"{path}/landed"))


@query(
    "group_split",
    sql(
        "select unit, row_number() over (order by md5(unit || ':42'), unit) <= ceil(0.2 * count(*) over ()) "
        "as is_validation from (select distinct unit from t)",
        "t",
    ),
)
def group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.split_units(events(spark, sf_dir).withColumnRenamed("user_id", "unit"))


@query(
    "split_row_counts",
    sql(
        "select case when is_validation then 'validation' else 'train' end as split, count(*) as n, "
        "count(distinct unit) as units from t join (select unit, row_number() over (order by md5(unit || ':42'), unit) "
        "<= ceil(0.2 * count(*) over ()) as is_validation from (select distinct unit from t)) using (unit) group by 1",
        "t",
    ),
)
def split_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumnRenamed("user_id", "unit")
    train, validation = prepare.train_validation(rows)
    both = train.withColumn("split", F.lit("train")).unionByName(validation.withColumn("split", F.lit("validation")))
    per_unit = both.groupBy("split", "unit").agg(F.count(F.lit(1)).alias("c"))
    return per_unit.groupBy("split").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("units"))


# --- windows -------------------------------------------------------------------------------------


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows with the kept sensors as one float array."""
    return labelled(spark, sf_dir).select("unit", "cycle", "rul", sensor_row(KEEP_SENSORS).alias("row"))


def _window_facts(features: str) -> list[Column]:
    first = F.transform(features, lambda r: r[0].cast("double"))
    last_row = F.element_at(F.col(features), -1)
    return [
        F.size(features).cast("bigint").alias("n_rows"),
        F.round(F.aggregate(first, F.lit(0.0), lambda t, x: t + x), 6).alias("sum_s2"),
        F.round(F.col(features)[0][0].cast("double"), 6).alias("first_s2"),
        F.round(last_row[WIDTH - 1].cast("double"), 6).alias("last_s21"),
    ]


@query(
    "sliding_sequences",
    sql(
        "select unit, cycle as end_cycle, rul as label, count(*) over w as n_rows, "
        "round(sum(cast(cast(s2 as real) as double)) over w, 6) as sum_s2, "
        "round(cast(cast(first_value(s2) over w as real) as double), 6) as first_s2, "
        "round(cast(cast(s21 as real) as double), 6) as last_s21 from r "
        "window w as (partition by unit order by cycle rows between 29 preceding and current row) "
        "qualify count(*) over w = 30",
        "t",
        r=RUL,
    ),
)
def sliding_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = windows.sliding_frames(vectors(spark, sf_dir), "unit", ["cycle"], "row", contiguous=True)
    return frames.select(
        "unit", F.col("cycle").alias("end_cycle"), F.col("rul").alias("label"), *_window_facts("features")
    )


PADDED_WINDOW = 70  # about the length of a series, so that many need padding


@query(
    "last_sequence_padded",
    sql(
        f"select unit, p as pos, coalesce(round(cast(cast(s2 as real) as double), 6), 0) as s2, "
        f"coalesce(round(cast(cast(s21 as real) as double), 6), 0) as s21 "
        f"from (select distinct unit from t) u cross join (select unnest(range(1, {PADDED_WINDOW + 1})) as p) g "
        f"left join (select unit, s2, s21, {PADDED_WINDOW} + 1 - row_number() over (partition by unit order by cycle desc) as p "
        f"from t) d using (unit, p)",
        "t",
    ),
)
def last_sequence_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = windows.last_frames(vectors(spark, sf_dir), "unit", ["cycle"], "row", WIDTH, PADDED_WINDOW)
    rows = last.select("unit", F.posexplode("features").alias("i", "r"))
    return rows.select(
        "unit",
        (F.col("i") + 1).cast("bigint").alias("pos"),
        F.round(F.col("r")[0].cast("double"), 6).alias("s2"),
        F.round(F.col("r")[WIDTH - 1].cast("double"), 6).alias("s21"),
    )


@query(
    "last_row_per_unit",
    sql(
        "select unit, max(cycle) as cycle, arg_max(a, cycle) as s2, arg_max(b, cycle) as s3 from "
        "(select unit, cycle, case when os2 < 0.05 then s2 end as a, case when os2 >= 0.05 then s3 end as b from t) "
        "group by unit",
        "t",
    ),
)
def last_row_per_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the values are NULL; the last known one counts."""
    gaps = telemetry(spark, sf_dir).withColumns(
        {"s2": F.when(F.col("os2") < 0.05, F.col("s2")), "s3": F.when(F.col("os2") >= 0.05, F.col("s3"))}
    )
    return prepare.last_values(gaps, "unit", "cycle", ["s2", "s3"])


#: Readings of a push buffer that counts as full; about half of the units have as many.
BUFFER = 66


@query(
    "last_n_readings",
    sql(
        f"select unit, count(*) as buffered, count(*) >= {BUFFER} as ready, min(event_id) as oldest, max(event_id) as newest, "
        "round(sum(value), 6) as total from (select user_id as unit, event_id, value, "
        f"row_number() over (partition by user_id order by event_id desc) as rn from e) where rn <= {BUFFER} group by unit",
        "e",
    ),
)
def last_n_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events(spark, sf_dir).withColumnRenamed("user_id", "unit")
    held = windows.last_readings(log, "unit", ["event_id"], ["event_id", "value"], BUFFER)
    r = F.col("readings")
    return held.select(
        "unit",
        "buffered",
        "ready",
        r[0]["event_id"].alias("oldest"),
        F.element_at(r, -1)["event_id"].alias("newest"),
        F.round(F.aggregate(r, F.lit(0.0), lambda t, x: t + x["value"]), 6).alias("total"),
    )


@query(
    "buffer_sizes",
    sql(
        f"select user_id as unit, least(count(*), {BUFFER}) as buffered, count(*) >= {BUFFER} as ready from e group by user_id",
        "e",
    ),
)
def buffer_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.buffer_sizes(events(spark, sf_dir).withColumnRenamed("user_id", "unit"), "unit", BUFFER)


ACCEPTED = (
    "select * from (select *, max(cycle) over (partition by engine_id order by arrival "
    "rows between unbounded preceding and 1 preceding) as top from c) where top is null or cycle > top"
)


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded, scaled events as a stored table; the ordered operators read it more than once."""
    decoded = event_source.decode(messages(spark, sf_dir))
    scaled = decoded.withColumn("vector", normalized_vector("sensors", LIMITS)).drop("sensors")
    return materialized(scaled, "arrivals")


@query(
    "running_max_dedupe",
    sql("select engine_id, cycle, event_time_ms, arrival from a", "m", c=CLAMPED, a=ACCEPTED),
)
def running_max_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = windows.accepted(arrivals(spark, sf_dir), "engine_id", ["arrival"], "cycle")
    return kept.select("engine_id", F.col("cycle").cast("bigint").alias("cycle"), "event_time_ms", "arrival")


FRAME_FACTS = (
    "select engine_id, cycle, event_time_ms as event_time, "
    "round(sum(cast(vec[1] as double)) over w, 6) as sum_s2, "
    "round(cast(first_value(vec[2]) over w as double), 6) as first_s3, "
    "round(cast(vec[10] as double), 6) as last_s20, cast({n} as bigint) as window_size, "
    "cast(11 as bigint) as n_sensors from a "
    "window w as (partition by engine_id order by arrival rows between {n} - 1 preceding and current row) "
    "qualify count(*) over w = {n}"
)


def flat_facts(features: str, window: int) -> list[Column]:
    """What the SQL twins can say about a flat feature vector."""
    f = F.col(features)
    s2 = F.filter(f, lambda _, i: i % WIDTH == 0)
    return [
        F.round(F.aggregate(s2, F.lit(0.0), lambda t, x: t + x.cast("double")), 6).alias("sum_s2"),
        F.round(f[1].cast("double"), 6).alias("first_s3"),
        F.round(F.element_at(f, -2).cast("double"), 6).alias("last_s20"),
        F.lit(window).cast("bigint").alias("window_size"),
        F.lit(WIDTH).cast("bigint").alias("n_sensors"),
    ]


@query("arrival_windows", sql(FRAME_FACTS.format(n=10), "m", c=CLAMPED, a=ACCEPTED))
def arrival_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = windows.arrival_frames(arrivals(spark, sf_dir), "engine_id", ["arrival"], "cycle", "vector", 10)
    flat = frames.withColumn("features", F.flatten("features"))
    return flat.select(
        "engine_id", F.col("cycle").cast("bigint").alias("cycle"), F.col("event_time_ms").alias("event_time"),
        *flat_facts("features", 10),
    )


# --- sources and validation ----------------------------------------------------------------------


@query(
    "raw_text_scan",
    sql(
        "select unit, count(*) as n, max(cycle) as last_cycle, round(sum(os1), 6) as os1, round(sum(s21), 6) as s21 "
        "from t group by unit",
        "t",
    ),
)
def raw_text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows written as blank-separated lines and scanned again."""
    path = fresh_dir(spark, "raw")
    tokens = raw_tokens(telemetry(spark, sf_dir))
    tokens.select(F.concat(F.array_join("tokens", " "), F.lit("  "))).write.text(f"{path}/source")
    rows = text.telemetry_rows(text.land(spark, f"{path}/source", f"{path}/landed"))
    return rows.groupBy(F.col("unit").cast("bigint").alias("unit")).agg(
        F.count(F.lit(1)).alias("n"),
        F.max("cycle").cast("bigint").alias("last_cycle"),
        F.round(F.sum("os1"), 6).alias("os1"),
        F.round(F.sum("s21"), 6).alias("s21"),
    )


@query(
    "event_envelope_roundtrip",
    sql(
        "select engine_id, cycle, event_time_ms, round(s2, 6) as s2, round(s20, 6) as s20, "
        "cast(0 as double) as s21 from m",
        "m",
    ),
)
def event_envelope_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_tokens(telemetry(spark, sf_dir)).withColumn("ms", scalars.epoch_ms("ts"))
    sent = event_source.events_from_lines(rows, F.col("ms"), [s for s in KEEP_SENSORS if s != "s21"])
    decoded = event_source.decode(sent.select("value"))
    value = F.col("sensors")
    return rounded(
        decoded.select(
            "engine_id",
            F.col("cycle").cast("bigint").alias("cycle"),
            "event_time_ms",
            value["s2"].alias("s2"),
            value["s20"].alias("s20"),
            F.coalesce(value["s21"], F.lit(0.0)).alias("s21"),
        ),
        "s2",
        "s20",
        "s21",
    )


@query(
    "dead_letters",
    sql(
        "select arrival, case when event_type = 'error' then 'cut' else 'no cycle' end as damage from "
        "(select (event_id // 997) * 997 + (event_id * 131) % 997 as arrival, event_type from e "
        "where event_type in ('error', 'signup'))",
        "e",
    ),
)
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors send cut text, signups forget the cycle; both end up as dead letters."""
    kinds = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("arrival_id"), "event_type"
    )
    rows = messages(spark, sf_dir)
    back = kinds.withColumn(
        "arrival", F.floor(F.col("arrival_id") / 997) * 997 + (F.col("arrival_id") * 131) % 997
    )
    cut = F.substring("value", 1, 40)
    forgot = F.regexp_replace("value", '"cycle":[0-9]+,', "")
    sent = rows.join(back, "arrival").withColumn(
        "value",
        F.when(F.col("event_type") == "error", cut).when(F.col("event_type") == "signup", forgot).otherwise(F.col("value")),
    )
    damage = F.when(F.col("event_type") == "error", "cut").otherwise("no cycle")
    return event_source.dead_letters(sent).select("arrival", damage.alias("damage"))


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry lines of two files with planted faults, and a file of values below zero."""
    raw = raw_tokens(telemetry(spark, sf_dir))
    eid = F.col("event_id")
    short = F.slice("tokens", 1, len(RAW_COLUMNS) - 1)
    word = F.transform("tokens", lambda t, i: F.when(i == 9, F.lit("x1")).otherwise(t))
    jump = F.transform(
        "tokens", lambda t, i: F.when(i == 1, (F.col("cycle") + 1000).cast("string")).otherwise(t)
    )
    main = raw.select(
        F.concat(F.lit("/data/train_"), (F.col("unit") % 2).cast("string"), F.lit(".txt")).alias("file"),
        F.floor(eid / 1000).alias("block"),
        eid.alias("row"),
        F.when(eid % 997 == 0, short).when(eid % 613 == 0, word).when(eid % 401 == 0, jump).otherwise(F.col("tokens")).alias("tokens"),
    )
    rul = events(spark, sf_dir).select(
        F.lit("/data/rul_all.txt").alias("file"),
        F.floor(eid / 1000).alias("block"),
        eid.alias("row"),
        F.array((F.col("k") - 3).cast("int").cast("string")).alias("tokens"),
    )
    return main.unionByName(rul)


_FAULTS = (
    "select 'train_' || (unit % 2) || '.txt' as file, event_id, unit, event_id % 997 = 0 as short, "
    "event_id % 997 <> 0 and event_id % 613 = 0 as word, "
    "case when event_id % 997 <> 0 and event_id % 613 <> 0 and event_id % 401 = 0 then cycle + 1000 else cycle end as c from t"
)
_ORDER = "select *, lag(c) over (partition by file, unit order by event_id) > c as back from d"
REPORT = (
    "select file, 'column_count' as rule, count(*) filter (where short) as violations from o group by file "
    "union all select file, 'numeric', count(*) filter (where word) from o group by file "
    "union all select file, 'monotonic_cycle', count(*) filter (where back) from o group by file "
    "union all select 'rul_all.txt', 'column_count', 0 "
    "union all select 'rul_all.txt', 'numeric', 0 "
    "union all select 'rul_all.txt', 'non_negative', count(*) filter (where k - 3 < 0) from e"
)


@query(
    "validation_report",
    sql("select file as name, rule, violations, violations = 0 as passed from q", "t", d=_FAULTS, o=_ORDER, q=REPORT),
)
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validate_files(damaged_lines(spark, sf_dir))


@query(
    "validation_status",
    sql(
        "select 'failed' as status, (select file || ': ' || rule || ' has ' || violations || ' violations' from q "
        "where violations > 0 order by file, rule limit 1) as error",
        "t",
        d=_FAULTS,
        o=_ORDER,
        q=REPORT,
    ),
)
def validation_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.validate_files(damaged_lines(spark, sf_dir))
    return quality.validation_status(report).select("status", "error")


@query(
    "history_final_epoch",
    sql(
        "select event_type as run, arg_max(l, d) as loss, arg_max(m, d) as rmse from (select event_type, "
        "cast(ts as date) as d, round(avg(value), 6) as l, round(max(value), 6) as m from e group by 1, 2) group by 1",
        "e",
    ),
)
def history_final_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.history_final(_history(spark, sf_dir), ["loss", "rmse"])


@query(
    "history_epochs",
    sql(
        "select event_type as run, row_number() over (partition by event_type order by d) as epoch, l as loss, m as rmse "
        "from (select event_type, cast(ts as date) as d, round(avg(value), 6) as l, round(max(value), 6) as m "
        "from e group by 1, 2)",
        "e",
    ),
)
def history_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.history_epochs(_history(spark, sf_dir), ["loss", "rmse"])
    return rows.withColumn("epoch", F.col("epoch").cast("bigint"))


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One history per event type with a value per day."""
    daily = events(spark, sf_dir).groupBy("event_type", F.to_date("ts").alias("d")).agg(
        F.round(F.avg("value"), 6).alias("loss"), F.round(F.max("value"), 6).alias("rmse")
    )
    days = F.sort_array(F.collect_list(F.struct("d", "loss", "rmse"))).alias("days")
    return daily.groupBy(F.col("event_type").alias("run")).agg(days).select(
        "run", F.create_map(F.lit("loss"), F.col("days.loss"), F.lit("rmse"), F.col("days.rmse")).alias("history")
    )


@query(
    "prediction_log_scan",
    sql(
        "select risk_level, count(*) as n, round(avg(latency), 6) as latency_ms, sum(remaining_cycles) as cycles "
        "from (select *, round(value, 2) as latency from p) group by risk_level",
        "p",
    ),
)
def prediction_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions written as structured log lines, with other lines between, and scanned again."""
    from vanewatch.plans.testviews import predictions

    path = fresh_dir(spark, "log")
    rows = predictions(spark, sf_dir)
    done = tables.log_lines(
        F.col("ts").cast("string"),
        F.lit("Prediction completed"),
        engine_id=F.col("engine_id"),
        rul=F.col("remaining_cycles"),
        risk=F.col("failure_risk"),
        risk_level=F.col("risk_level"),
        latency_ms=F.round("value", 2),
        confidence=F.col("confidence"),
    )
    other = tables.log_lines(F.col("ts").cast("string"), F.lit("Model loaded"))
    rows.select(done.alias("value")).union(rows.select(other)).write.text(path)
    log = tables.read_prediction_log(spark, path).where(F.col("risk_level").isNotNull())
    return log.groupBy("risk_level").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("latency_ms"), 6).alias("latency_ms"),
        F.sum("rul").cast("bigint").alias("cycles"),
    )


@query(
    "scaler_export",
    sql(
        "select cast(list_position(["
        + ", ".join(f"'{s}'" for s in KEEP_SENSORS)
        + "], sensor) as bigint) as position, sensor, round(mn, 8) as mn, round(mx, 8) as mx from f where sensor <> 's1'",
        "t",
        f=FIT,
    ),
)
def scaler_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "scaler")
    params = prepare.minmax_fit(train_rows(telemetry(spark, sf_dir)), KEEP_SENSORS)
    tables.write_scaler(params, path, KEEP_SENSORS, WINDOW, 125)
    written = spark.read.parquet(f"{path}/scaler")
    return written.withColumn("position", F.col("position").cast("bigint"))


@query(
    "latest_features",
    sql(
        "select 'ENG-' || unit as engine_id, max(cycle) as cycle, arg_max(round(s2, 6), cycle) as s2 from t group by unit",
        "t",
    ),
)
def latest_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = telemetry(spark, sf_dir).select(F.concat(F.lit("ENG-"), "unit").alias("engine_id"), "cycle", "s2")
    return rounded(latest_per_key(rows, ["engine_id"], ["cycle"]), "s2")

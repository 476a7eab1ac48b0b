"""The supplied tables seen as fleet telemetry, in Spark and in SQL.

``events`` becomes a 26-column telemetry table: a user is a unit, its events in time order are its
cycles, and value and ``props.k`` feed the sensors. Sensors outside the kept list are constant.
The same events also serve as prediction log, alert log and metric samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewatch.functions import scalars
from vanewatch.operators.ordering import with_ordinal
from vanewatch.operators.scoring import prediction_records
from vanewatch.sources.events import envelope
from vanewatch.spec import KEEP_SENSORS, RAW_COLUMNS, SENSORS

MIDDLE = "2024-01-16 00:00:00"  # reference | current
AS_OF = "2024-01-30 12:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def stamp(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("double")
    )


def sensor(name: str) -> Column:
    i = int(name[1:])
    if name in KEEP_SENSORS:
        return F.col("value") + F.lit(float(i)) * F.col("k")
    return F.lit(100.0 + i)


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """unit, cycle, os1..os3, s1..s21, and event_id and ts for ordering."""
    numbered = with_ordinal(
        events(spark, sf_dir).withColumnRenamed("user_id", "unit"), ["unit"], ["ts", "event_id"], "cycle"
    )
    return numbered.select(
        "unit",
        "cycle",
        (F.col("value") / 1000.0).alias("os1"),
        (F.col("k") / 1000.0).alias("os2"),
        F.lit(100.0).alias("os3"),
        *[sensor(s).alias(s) for s in SENSORS],
        "event_id",
        "ts",
    )


def raw_tokens(df: DataFrame) -> DataFrame:
    """Telemetry rows as the text tokens of a raw line."""
    return df.withColumn("tokens", F.array(*[F.col(c).cast("string") for c in RAW_COLUMNS]))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON event per row, without a cycle order in arrival; sensor s21 is missing.

    ``arrival`` mixes the order inside a week, so that many events come late.
    """
    rows = telemetry(spark, sf_dir)
    sensors = {s: F.col(s) for s in KEEP_SENSORS if s != "s21"}
    return rows.select(
        arrival(F.col("event_id")).alias("arrival"),
        envelope(
            F.concat(F.lit("ENG-"), "unit"),
            F.col("cycle").cast("int"),
            scalars.epoch_ms("ts"),
            sensors,
        ).alias("value"),
    )


def arrival(event_id: Column) -> Column:
    """Arrival number: blocks of 997 events arrive in a shuffled but fixed order."""
    return F.floor(event_id / 997) * 997 + (event_id * 131) % 997


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a logged prediction with y = k / 100."""
    base = events(spark, sf_dir).select(
        F.struct(
            F.concat(F.lit("ENG-"), F.col("user_id")).alias("engine_id"),
            "event_id", "ts", "event_type", "value", "k",
        ).alias("row"),
        (F.col("k") / 100.0).alias("y"),
    )
    records = prediction_records(base, "y", F.col("row.ts"), "v1", key="row")
    return records.select("row.*", *[c for c in records.columns if c != "row"])


# --- SQL twins -----------------------------------------------------------------------------------


def _sql_sensor(name: str) -> str:
    i = int(name[1:])
    if name in KEEP_SENSORS:
        return f"value + cast({i}.0 as double) * k as {name}"
    return f"cast({100 + i}.0 as double) as {name}"


VIEWS = {
    "e": "select *, cast(json_extract_string(props, '$.k') as double) as k from events",
    "t": (
        "select user_id as unit, row_number() over (partition by user_id order by ts, event_id) as cycle, "
        "value / cast(1000.0 as double) as os1, k / cast(1000.0 as double) as os2, cast(100.0 as double) as os3, "
        + ", ".join(_sql_sensor(s) for s in SENSORS)
        + ", event_id, ts from e"
    ),
    "m": (
        "select (event_id // 997) * 997 + (event_id * 131) % 997 as arrival, "
        "'ENG-' || unit as engine_id, cycle, epoch_us(ts) // 1000 as event_time_ms, * exclude (unit, cycle) from t"
    ),
    "p": (
        "select *, case when risk >= 0.8 then 'CRITICAL' when risk >= 0.6 then 'HIGH' "
        "when risk >= 0.3 then 'MEDIUM' else 'LOW' end as risk_level, "
        "cast(round_even(rul, 0) as bigint) as remaining_cycles, round_even(risk, 3) as failure_risk "
        "from (select *, greatest(cast(0.0 as double), least(cast(1.0 as double), "
        "cast(1.0 as double) - rul / cast(125.0 as double))) as risk "
        "from (select *, 'ENG-' || user_id as engine_id, "
        "k / cast(100.0 as double) * cast(125.0 as double) as rul from e))"
    ),
    "latest": (
        "select * from (select *, row_number() over (partition by engine_id order by ts desc, event_id desc) as rn "
        "from p) where rn = 1"
    ),
}
_NEEDS = {"t": ["e"], "m": ["e", "t"], "p": ["e"], "latest": ["e", "p"]}


def sql(body: str, *views: str, **more: str) -> str:
    """``body`` with the named views, and ``more`` views after them, as common table expressions."""
    names: list[str] = []
    for view in views:
        for name in [*_NEEDS.get(view, []), view]:
            if name not in names:
                names.append(name)
    parts = [f"{n} as ({VIEWS[n]})" for n in names] + [f"{n} as ({q})" for n, q in more.items()]
    return f"with {', '.join(parts)} {body}" if parts else body

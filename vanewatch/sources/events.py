"""JSON telemetry events: encode, decode, dead letters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewatch.spec import ENGINE_PREFIX, KEEP_SENSORS, RAW_COLUMNS

EVENT_SCHEMA = "engine_id STRING, cycle INT, event_time_ms BIGINT, sensors MAP<STRING, DOUBLE>"


def envelope(
    engine_id: Column, cycle: Column, event_time_ms: Column, sensors: dict[str, Column]
) -> Column:
    """JSON text of one event."""
    readings = F.create_map(*[x for name, c in sensors.items() for x in (F.lit(name), c)])
    return F.to_json(
        F.struct(
            engine_id.alias("engine_id"),
            cycle.alias("cycle"),
            event_time_ms.alias("event_time_ms"),
            readings.alias("sensors"),
        )
    )


def events_from_lines(
    lines: DataFrame, event_time_ms: Column, sensors: Sequence[str] = KEEP_SENSORS
) -> DataFrame:
    """Raw token rows to ``key, value`` messages; rows with too few tokens are skipped."""

    def token(name: str) -> Column:
        return F.get("tokens", F.lit(RAW_COLUMNS.index(name)))

    engine = F.concat(F.lit(ENGINE_PREFIX), token("unit"))
    return lines.where(F.size("tokens") >= len(RAW_COLUMNS)).select(
        engine.alias("key"),
        envelope(
            engine,
            token("cycle").cast("int"),
            event_time_ms,
            {s: token(s).cast("double") for s in sensors},
        ).alias("value"),
    )


def valid_event(value: Column | str) -> Column:
    """The parsed event in an array of one, or an empty array when a required field is missing.

    Broken text parses to a struct of NULLs, so the fields are tested and not the struct. Inside
    one array expression the text is parsed once, however many fields are used later.
    """
    value = F.col(value) if isinstance(value, str) else value
    event = F.from_json(value.cast("string"), EVENT_SCHEMA)

    def complete(e: Column) -> Column:
        return (
            e["engine_id"].isNotNull()
            & e["cycle"].isNotNull()
            & e["event_time_ms"].isNotNull()
            & e["sensors"].isNotNull()
        )

    return F.filter(F.array(event), complete)


def decode(messages: DataFrame) -> DataFrame:
    """Valid events as columns, next to the other columns of the message."""
    keep = [c for c in messages.columns if c not in ("key", "value")]
    return messages.select(*keep, F.inline(valid_event("value")))


def dead_letters(messages: DataFrame) -> DataFrame:
    return messages.where(F.size(valid_event("value")) == 0)

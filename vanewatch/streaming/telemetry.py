"""Telemetry ticks: at each tick the newest reading of every live engine, from state that engines leave by a timer."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vanewatch.spec import STATE_BUCKETS, TTL_SECONDS, WINDOW

TICK_SCHEMA = "tick_ms BIGINT, engine_id STRING, cycle BIGINT, event_time_ms BIGINT, window_size BIGINT"
# parallel lists, one entry per engine and tick: the tick that the engine comes to next, and its newest write before a tick
_STATE = (
    "engines ARRAY<STRING>, next ARRAY<BIGINT>, ticks ARRAY<BIGINT>, written ARRAY<BIGINT>, "
    "cycles ARRAY<BIGINT>, times ARRAY<BIGINT>, arrivals ARRAY<BIGINT>"
)
_WRITE = ["written_ms", "cycle", "event_time_ms", "arrival"]


def telemetry_ticks(
    writes: DataFrame,
    interval_ms: int,
    ttl_ms: int = TTL_SECONDS * 1000,
    late: str = "10 minutes",
    origin_ms: int = 0,
    window: int = WINDOW,
    buckets: int = STATE_BUCKETS,
) -> DataFrame:
    """A row per tick and live engine: its newest write up to the tick, unless that is ``ttl_ms`` old.

    Input: ``engine_id, written_at, arrival, cycle, event_time_ms``; ``arrival`` orders writes of the same
    time. A tick at ``origin_ms + k * interval_ms`` is complete when the watermark, ``late`` behind the
    newest write, has passed it. Engines share a state and a timer by hash, in ``buckets``, since a call of
    Python for each engine costs more than its work. A bucket's timer stands at the next tick of any of its
    engines; state holds one write per engine and open tick and the last one before, and an engine leaves
    it when that has expired and none is open. Engines without new writes report from the timers. Nothing
    is emitted for ticks between an expiry and the next write.
    """

    def advanced(held: dict[int, tuple], upcoming: int, passed: int) -> tuple[int | None, list[tuple]]:
        """Rows of one engine's ticks up to ``passed`` and its next tick; takes from ``held`` what is over."""
        out = []
        while upcoming <= passed:
            before = [t for t in held if t <= upcoming]
            last = held[max(before)] if before else None
            at = origin_ms + upcoming * interval_ms
            if last and last[0] > at - ttl_ms:
                out.append((at, last[1], last[2]))
                upcoming += 1
            else:  # nothing to report until the next write
                upcoming = min((t for t in held if t > upcoming), default=passed + 1)
        stale = sorted(t for t in held if t < upcoming)
        for t in stale[:-1]:
            del held[t]
        if stale and held[stale[-1]][0] <= origin_ms + upcoming * interval_ms - ttl_ms:
            del held[stale[-1]]  # expired before its next tick
            upcoming = min(held, default=None)
        return upcoming, out

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held: dict[str | None, dict[int, tuple[int, int, int, int]]] = {}
        upcoming: dict[str | None, int] = {}
        if state.exists:
            for engine, coming, t, *entry in zip(*state.get, strict=True):
                held.setdefault(engine, {})[t] = tuple(entry)
                upcoming[engine] = coming
        if not state.hasTimedOut:
            for batch in frames:
                tick = -((origin_ms - batch["written_ms"]) // interval_ms)  # the first one not before the write
                newest = (
                    batch.assign(tick=tick)
                    .sort_values(["written_ms", "arrival"])
                    .groupby(["engine_id", "tick"], dropna=False, sort=False)[_WRITE]
                    .last()
                    .reset_index()
                )
                newest = newest[newest["tick"].notna()]
                engines = newest["engine_id"].astype(object).where(newest["engine_id"].notna(), None)
                numbers = (newest[c].astype("int64").tolist() for c in ["tick", *_WRITE])
                for engine, t, *entry in zip(engines, *numbers, strict=True):
                    own = held.setdefault(engine, {})
                    old = own.get(t)
                    if old is None or (old[0], old[3]) < (entry[0], entry[3]):
                        own[t] = tuple(entry)
        passed = (state.getCurrentWatermarkMs() - 1 - origin_ms) // interval_ms
        out, rows = [], []
        for engine, own in held.items():
            coming, ticks = advanced(own, upcoming.get(engine, min(own)), passed)
            out.extend((at, engine, cycle, time, window) for at, cycle, time in ticks)
            rows.extend((engine, coming, t, *own[t]) for t in sorted(own))
        if rows:
            state.update(tuple(list(x) for x in zip(*rows, strict=True)))
            state.setTimeoutTimestamp(int(origin_ms + min(row[1] for row in rows) * interval_ms))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["tick_ms", "engine_id", "cycle", "event_time_ms", "window_size"])

    stamped = writes.select(
        "engine_id", F.col("written_at").cast("timestamp").alias("written_at"), "arrival", "cycle", "event_time_ms"
    ).withColumns({"written_ms": F.unix_millis("written_at"), "bucket": F.pmod(F.hash("engine_id"), F.lit(buckets))})
    return (
        stamped.withWatermark("written_at", late)
        .groupBy("bucket")
        .applyInPandasWithState(step, TICK_SCHEMA, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    )

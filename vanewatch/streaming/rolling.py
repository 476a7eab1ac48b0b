"""Rolling windows over a stream of readings, keyed by engine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vanewatch.functions.vectors import normalized_vector
from vanewatch.sources.events import decode
from vanewatch.spec import STATE_BUCKETS, WINDOW

FEATURE_SCHEMA = (
    "engine_id STRING, cycle INT, event_time BIGINT, features ARRAY<FLOAT>, window_size INT, n_sensors INT"
)
# per engine its last cycle and number of rows; the rows of all engines one after the other, as float32
_STATE_SCHEMA = "engines ARRAY<STRING>, last_cycles ARRAY<INT>, lengths ARRAY<INT>, rows BINARY"
_ROWS_PER_FRAME = 2_000


def in_arrival_order(frames: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """The rows of one key in one micro-batch, oldest first."""
    parts = list(frames)
    batch = parts[0] if len(parts) == 1 else pd.concat(parts)
    if batch["arrival"].is_monotonic_increasing:
        return batch
    return batch.sort_values("arrival", kind="stable")


def normalized_events(messages: DataFrame, limits: dict[str, tuple[float, float]]) -> DataFrame:
    """Stateless part: decode, drop broken messages, scale. Works on streams and on tables."""
    return decode(messages).withColumn("vector", normalized_vector("sensors", limits)).drop("sensors")


def rolling_features(
    events: DataFrame, n_sensors: int, window: int = WINDOW, buckets: int = STATE_BUCKETS
) -> DataFrame:
    """A feature vector for every accepted reading once an engine has ``window`` of them.

    A reading is accepted when its cycle is above all earlier ones of the engine; ``arrival``
    orders the readings of one micro-batch. Engines share a state by hash, in ``buckets``, since a call
    of Python for each engine costs more than its work. State: per engine the last cycle and the rows
    of the window. A task holds the readings of one bucket in one micro-batch, which the source limits
    (``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``).
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        batch = in_arrival_order(frames)
        known, last, lengths, held = state.get if state.exists else ([], [], [], b"")
        # numbers of the engines: the known ones keep their places
        codes, engines = pd.factorize(
            np.concatenate([np.array(known, dtype=object), batch["engine_id"].to_numpy(dtype=object)]), use_na_sentinel=False
        )
        codes = codes[len(known) :]
        by_engine = np.argsort(codes, kind="stable")
        batch, codes = batch.iloc[by_engine], codes[by_engine]

        cycles = batch["cycle"].to_numpy(dtype=np.int64)
        floor = np.full(len(engines), np.iinfo(np.int64).min)
        floor[: len(known)] = last
        highest = pd.Series(cycles).groupby(codes).cummax().to_numpy()
        before = np.concatenate([floor[:1], highest[:-1]])
        before[np.concatenate([[True], codes[1:] != codes[:-1]])] = np.iinfo(np.int64).min
        keep = cycles > np.maximum(before, floor[codes])
        if not keep.any():
            return
        batch, codes, cycles = batch[keep], codes[keep], cycles[keep]

        # the rows of an engine one after the other, those from the state first
        old = np.repeat(np.arange(len(known)), lengths)
        owner = np.concatenate([old, codes])
        order = np.argsort(owner, kind="stable")
        owner = owner[order]
        fresh = np.stack(batch["vector"].to_numpy()).astype(np.float32, copy=False)
        series = np.concatenate([np.frombuffer(held, dtype=np.float32).reshape(-1, n_sensors), fresh])[order]
        counts = np.bincount(owner, minlength=len(engines))
        place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)

        floor[codes] = cycles  # cycles rise, and the last one stays
        kept = place >= counts[owner] - window
        state.update(
            (
                [None if pd.isna(e) else e for e in engines],
                floor.tolist(),
                np.minimum(counts, window).tolist(),
                series[kept].tobytes(),
            )
        )

        source = order - len(old)  # place in the batch, below 0 for rows from the state
        ready = np.flatnonzero((source >= 0) & (place >= window - 1))
        times = batch["event_time_ms"].to_numpy()
        for start in range(0, len(ready), _ROWS_PER_FRAME):
            ends = ready[start : start + _ROWS_PER_FRAME]
            rows = source[ends]
            yield pd.DataFrame(
                {
                    "engine_id": batch["engine_id"].to_numpy()[rows],
                    "cycle": cycles[rows].astype(np.int32),
                    "event_time": times[rows],
                    "features": list(series[ends[:, None] + np.arange(1 - window, 1)].reshape(len(ends), -1)),
                    "window_size": np.int32(window),
                    "n_sensors": np.int32(n_sensors),
                }
            )

    bucket = F.pmod(F.hash("engine_id"), F.lit(buckets))
    return events.withColumn("bucket", bucket).groupBy("bucket").applyInPandasWithState(
        step, FEATURE_SCHEMA, _STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )

"""The latest-features view over an append-only feature log, and joins against it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewatch.operators.ordering import latest_per_key
from vanewatch.operators.quality import stored_vector_fits
from vanewatch.spec import BUFFER_SOURCE, STORE_SOURCE, TTL_SECONDS, WINDOW


def live(log: DataFrame, as_of: Column, written: str = "written_at", ttl: int = TTL_SECONDS) -> DataFrame:
    """Log rows an observer at ``as_of`` still sees: written by then, and not expired.

    An entry expires ``ttl`` seconds after the last write of its key. The latest row carries that
    time, so filtering rows first keeps exactly the keys whose latest row is alive.
    """
    oldest = as_of - F.make_dt_interval(secs=F.lit(ttl))
    return log.where((F.col(written) > oldest) & (F.col(written) <= as_of))


def latest_features(
    log: DataFrame,
    as_of: Column,
    key: str = "engine_id",
    order: Sequence[str] = ("written_at", "arrival"),
    ttl: int = TTL_SECONDS,
) -> DataFrame:
    """One row per live key, last write wins. The time filter reaches the scan."""
    return latest_per_key(live(log, as_of, order[0], ttl), [key], order)


def active_engines(
    log: DataFrame, as_of: Column, key: str = "engine_id", written: str = "written_at", ttl: int = TTL_SECONDS
) -> DataFrame:
    return live(log, as_of, written, ttl).select(key).distinct()


def usable_features(view: DataFrame, window: int, width: int, features: str = "features") -> DataFrame:
    """Entries whose stored vector has the right length; others count as missing."""
    return view.where(stored_vector_fits(features, window, width))


def with_meta(features: DataFrame, meta: DataFrame, key: str = "engine_id", window: int = WINDOW) -> DataFrame:
    """Cycle and time of each feature entry; zero, zero and the usual window without meta data."""
    return features.join(meta, key, "left").withColumns(
        {
            "cycle": F.coalesce("cycle", F.lit(0)),
            "event_time_ms": F.coalesce("event_time_ms", F.lit(0)),
            "window_size": F.coalesce("window_size", F.lit(window)),
        }
    )


def lookup(requested: DataFrame, view: DataFrame, key: str = "engine_id") -> DataFrame:
    """Features of the requested keys; keys without features drop out."""
    return view.join(requested.select(key).distinct(), key, "left_semi")


def telemetry_snapshot(view: DataFrame, key: str = "engine_id", window: int = WINDOW) -> DataFrame:
    return view.select(
        key,
        F.coalesce("cycle", F.lit(0)).cast("bigint").alias("cycle"),
        F.coalesce("event_time_ms", F.lit(0)).alias("event_time_ms"),
        F.lit(window).cast("bigint").alias("window_size"),
    )


def telemetry_head(snapshot: DataFrame, n: int = 20, key: str = "engine_id") -> DataFrame:
    """First rows of the telemetry list in id order."""
    return snapshot.orderBy(key).limit(n)


def known_engines(store: DataFrame, buffer: DataFrame, key: str = "engine_id") -> DataFrame:
    return store.select(key).union(buffer.select(key)).distinct()


def engine_status(
    store: DataFrame,
    buffer: DataFrame,
    predictions: DataFrame,
    key: str = "engine_id",
    window: int = WINDOW,
) -> DataFrame:
    """Every engine in the store or the buffer, where it comes from, and its last prediction.

    ``store`` and ``predictions`` have one row per engine, ``buffer`` has (engine, buffered).
    """
    last = predictions.select(
        key, F.struct(*[c for c in predictions.columns if c != key]).alias("last_prediction")
    )
    merged = (
        store.select(key, F.lit(True).alias("in_store"))
        .join(buffer.select(key, "buffered"), key, "full")
        .join(last, key, "left")
    )
    in_store = F.coalesce("in_store", F.lit(False))
    return merged.select(
        key,
        F.when(in_store, STORE_SOURCE).otherwise(BUFFER_SOURCE).alias("source"),
        (in_store | (F.coalesce("buffered", F.lit(0)) >= window)).alias("ready"),
        "last_prediction",
    )

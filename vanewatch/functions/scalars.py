"""Scalar rules: clipping, scaling, risk, buckets, penalties."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vanewatch import spec


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# least/greatest skip NULL, and NaN compares above all numbers; both must pass through a clip.


def clip_upper(x: Column | str, hi: float) -> Column:
    x = _col(x).cast("double")
    return F.when((x > hi) & ~F.isnan(x), F.lit(float(hi))).otherwise(x)


def clip_between(x: Column | str, lo: float, hi: float) -> Column:
    x = _col(x).cast("double")
    return F.when(x < lo, F.lit(float(lo))).when((x > hi) & ~F.isnan(x), F.lit(float(hi))).otherwise(x)


def minmax(x: Column, lo: Column, hi: Column, clamped: bool = False) -> Column:
    """(x - lo) / (hi - lo); a zero range divides by one."""
    spread = hi - lo
    scaled = (x - lo) / F.when(spread == 0, F.lit(1.0)).otherwise(spread)
    return clip_between(scaled, 0.0, 1.0) if clamped else scaled


def normalized_target(rul: Column | str, clip: float = spec.CLIP) -> Column:
    return _col(rul) / F.lit(float(clip))


def denormalized_target(y: Column | str, clip: float = spec.CLIP) -> Column:
    return clip_between(_col(y) * F.lit(float(clip)), 0.0, clip)


def sample_weight(y: Column | str, late_life: bool = False) -> Column:
    """1 + 1.5 y by default; ``late_life`` gives the weight to low remaining life, 1 + 1.5 (1 - y)."""
    y = _col(y)
    return 1.0 + 1.5 * ((1.0 - y) if late_life else y)


def risk(rul: Column | str, clip: float = spec.CLIP) -> Column:
    return clip_between(1.0 - _col(rul) / F.lit(float(clip)), 0.0, 1.0)


def risk_band(score: Column | str) -> Column:
    """The band of a risk; NULL for a missing one."""
    score = _col(score)
    chain = F.when(score.isNull(), F.lit(None).cast("string"))
    for level, floor in spec.RISK_FLOORS.items():
        chain = chain.when(score >= floor, level)
    return chain.otherwise(spec.RISK_LEVELS[0])


def band_rank(level: Column | str) -> Column:
    level = _col(level)
    chain = F
    for rank, name in enumerate(spec.RISK_LEVELS):
        chain = chain.when(level == name, rank)
    return chain.otherwise(0)


def threshold_rank(level: str | None) -> int:
    """Rank of a requested minimum level; an unknown name counts as HIGH."""
    name = (level or "").upper()
    return spec.RISK_LEVELS.index(name) if name in spec.RISK_LEVELS else spec.UNKNOWN_THRESHOLD_RANK


def rul_bucket(rul: Column | str) -> Column:
    """Right-closed life buckets; values outside all of them give NULL."""
    rul = _col(rul)
    chain = F
    for lo, hi, name in spec.RUL_BUCKETS:
        chain = chain.when((rul > lo) & (rul <= hi), name)
    return chain.otherwise(F.lit(None).cast("string"))


def is_critical(rul: Column | str, limit: float = spec.CRITICAL_RUL) -> Column:
    return _col(rul) < limit


def penalty(error: Column | str) -> Column:
    """Late predictions (positive error) cost more than early ones."""
    error = _col(error)
    return F.when(error < 0, F.exp(-error / 13.0) - 1.0).otherwise(F.exp(error / 10.0) - 1.0)


def confidence(std: Column | str) -> Column:
    return F.bround(clip_between(1.0 - 10.0 * _col(std), 0.0, 1.0), 3)


def epoch_ms(ts: Column | str) -> Column:
    """Milliseconds since 1970 of a zone-less timestamp, whatever the session time zone."""
    ts = _col(ts)
    return (
        F.unix_date(F.to_date(ts)).cast("bigint") * 86_400_000
        + F.hour(ts) * 3_600_000
        + F.minute(ts) * 60_000
        + F.floor(F.date_part(F.lit("SECOND"), ts) * 1000).cast("bigint")
    )

"""Asymptotic p-value of the two-sample Kolmogorov-Smirnov statistic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TERMS = 100


def ks_p_value(d: Column, n: Column, m: Column) -> Column:
    """p = 2 sum (-1)^(j-1) exp(-2 j^2 lambda^2), with the usual small-sample correction of lambda."""
    effective = F.sqrt(n.cast("double") * m / (n + m))
    lam = (effective + 0.12 + 0.11 / effective) * d
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        F.lit(0.0),
        lambda total, j: total
        + F.when(j % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.exp(-2.0 * j * j * lam * lam),
    )
    p = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * series))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(p)

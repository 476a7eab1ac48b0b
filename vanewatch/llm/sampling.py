"""Hash tests and bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewatch.session import materialized

_STEPS = 1 << 30


def crc_bucket(id_column: Column, buckets: int) -> Column:
    """crc32 of an id as text, modulo ``buckets``; null for a null id."""
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(buckets))


def bounded(rows: DataFrame, id_column: str, most: int, seed: int = 5) -> DataFrame:
    """About ``most`` rows at the most, the same in every run: those whose id hashes below a level.

    Below ``most`` rows all are taken; the count that sets the level reads only the id column and what
    ``rows`` filters on.
    """
    n = rows.count()
    if n <= most:
        return rows
    level = int(_STEPS * most / n)
    return rows.where(F.pmod(F.xxhash64(F.lit(seed), F.col(id_column)), F.lit(_STEPS)) < level)


def bounded_by_group(rows: DataFrame, group: str, text: str, most: int, seed: int = 5) -> DataFrame:
    """Distinct (group, text), about ``most`` of each group at the most, the same in every run.

    Texts are chosen by a hash whose level follows from the group's rows; copies are chosen together and
    count once. Groups below ``most`` rows are taken whole.
    """
    counts = materialized(rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n")), "group-sizes")
    hashed = F.pmod(F.xxhash64(F.lit(seed), F.col(group), F.col(text)), F.lit(_STEPS))
    chosen = rows.join(counts, group).where((F.col("_n") <= most) | (hashed * F.col("_n") < F.lit(_STEPS * most)))
    keyed = chosen.select(group, text, F.md5(text).alias("_key"))
    return keyed.dropDuplicates([group, "_key"]).drop("_key")

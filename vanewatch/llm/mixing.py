"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target in words; its documents share one expected number of copies, target over
source size. The whole part is taken outright. The fractions are rounded by the pivotal method: a
document and its partner, all smaller documents that are still open taken as one, exchange mass (words) in
a random direction until one of them has an integral number of copies. The odds of the directions keep
every document's expected copies at its fraction, and the words taken from a source stay constant. Only the
last document, the smallest, and documents that outweigh all smaller ones of a source together are rounded
by a coin of their own, with as much made up by the others as keeps their expectations: a source misses its
target by less than such a document. Groups of at most about FAN documents of a source are reduced by one task each; what is
left of them, a document per group, is reduced again, until one document per source is left.

Randomness is a hash of seed and document: reruns agree. Null is a source of its own, ordered last.
Null or empty texts have size 0 and are taken 0 words. Of rows that agree in doc_id, source and text
(as many as their fractions sum up to in whole numbers) some are taken once more than the others, and
the fraction left is one document's, so repeats keep the words taken too. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vanewatch.llm.frames import boxed, unboxed, word_count
from vanewatch.session import materialized

#: Documents that one task reduces.
FAN = 1024
EDGE = 1e-9
#: Repeated rows are numbered in slices of at most 2^SLICE_BITS rows.
SLICE_BITS = 16


def units(docs: DataFrame) -> DataFrame:
    """Stored, thin rows: doc_id, source, key of the text, size in words, repeated rows."""
    thin = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").alias("source"),
        F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("text_key"),
        word_count(F.col("text")).alias("size"),
    )
    same = thin.groupBy("doc_id", "source", "text_key", "size").agg(F.count(F.lit(1)).alias("rows"))
    return materialized(same, "units")


def ranked(df: DataFrame, *order) -> DataFrame:
    """Add ``rank`` (0, 1, ...) over a whole table: range partitions, counted, then offset."""
    placed = materialized(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_place", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition of the sort
    starts = counts.selectExpr(
        "_part", "sum(_n) over (order by _part rows between unbounded preceding and current row) - _n as _start"
    )
    joined = placed.join(starts, part == F.col("_part"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return joined.withColumn("rank", F.col("_start") + inside).drop("_place", "_part", "_n", "_start")


def source_targets(
    thin: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """Per source: source_size, docs, target. Weights repeat over the sources in code-point order.

    Targets share ``share`` of all words by weight, stop at ``most`` times the source's words, and the
    excess is shared again among the others. The driver holds a level and two sums, not the sources.
    """
    totals = thin.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count(F.lit(1)).alias("docs")
    )
    by_rank = F.array(*[F.lit(w) for w in weights])
    per = ranked(totals, F.col("source").asc_nulls_last())
    per = per.withColumn("weight", by_rank[(F.col("rank") % len(weights)).cast("int")])
    per = materialized(per.withColumn("cap", F.col("source_size") * most), "sources")
    level, capped = 0.0, -1
    budget = share * (per.agg(F.sum("source_size")).first()[0] or 0)
    while True:
        over = F.col("weight") * F.lit(level) > F.col("cap")
        held, free, n = per.agg(
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
            F.count(F.when(over, 1)),
        ).first()
        if n == capped or not free:
            break
        level, capped = (budget - held) / free, n
    target = F.least(F.col("weight") * F.lit(level), F.col("cap")).cast("double")
    return per.select("source", "source_size", "docs", target.alias("target"))


def pivot(size: np.ndarray, x: np.ndarray, luck: np.ndarray, last: bool = False) -> tuple[np.ndarray, int]:
    """Round fractions so that the sum of size * x stays, but for one; returns them and its place or -1.

    Sizes fall. Each document in turn exchanges words with all later open ones, whose fractions move
    together; every step makes one of them integral. A step draws the luck of a document that drew none.
    With ``last`` nothing stays open: a document that outweighs what the later ones can give or take is
    rounded all the same, and they make up for as much of it as is fair in both directions.
    """
    x = np.where(size > 0, x, luck < x)
    x[x <= EDGE], x[x >= 1 - EDGE] = 0.0, 1.0
    open_ = (x > 0) & (x < 1)
    a, chance = -1, 0.0
    while open_.any():
        if a < 0 or not open_[a]:
            a = int(open_.argmax())
            chance = luck[a]
        rest = open_.copy()
        rest[a] = False
        words = size[rest].sum()
        up, down = (1 - x[a]) * size[a], x[a] * size[a]  # words that make a integral, from the rest or to it
        can_give, can_take = (x[rest].min() * words, (1 - x[rest].max()) * words) if words else (0.0, 0.0)
        if last:
            part = min(1.0, can_give / up, can_take / down)
            taken = chance < x[a]
            move = part * up if taken else -part * down
            x[a] = float(taken)
        elif words:
            up, down = min(up, can_give), min(down, can_take)
            move = up if chance * (up + down) < down else -down
            x[a] += move / size[a]
        else:
            return x, a
        if words:
            x[rest] -= move / words
        x[open_ & (x <= EDGE)], x[open_ & (x >= 1 - EDGE)] = 0.0, 1.0
        closed = np.flatnonzero(open_ & ((x == 0) | (x == 1)))
        open_[closed] = False
        if a not in closed:
            chance = luck[closed[0]]
    return x, -1


def _reduce(pdf: pd.DataFrame) -> pd.DataFrame:
    """One group: everything gets its copies, but for one document that keeps its fraction if others follow."""
    pdf = pdf.sort_values(["size", "text_key", "doc_id"], ascending=[False, True, True], kind="stable")
    size, x, luck = (pdf[c].to_numpy(float) for c in ("size", "x", "luck"))
    x, held = pivot(size, x, luck, bool(pdf["last"].iloc[0]))
    return pdf.assign(x=x, done=np.arange(len(x)) != held)[["source", "doc_id", "text_key", "size", "rows", "x", "done"]]


def copies(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 17,
    fan: int = FAN,
) -> DataFrame:
    """Per distinct document: doc_id, source, text_key, size, rows, source_size, target, copies, more.

    Each of its rows has ``copies``, ``more`` of them one more.
    """
    thin = units(docs)
    targets = materialized(source_targets(thin, weights, share, most), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate + EDGE)
    plan = targets.select(
        F.col("source").alias("plan_source"), "source_size", "target", "docs",
        whole.alias("whole"), F.greatest(rate - whole, F.lit(0.0)).alias("fraction"),
    )
    # one row a source: broadcast by its written size, else sorted with hot sources split
    found = thin.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")

    def draw(*what):
        """Uniform in [0, 1), another for each document, use and seed."""
        return F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text_key", *map(F.lit, what)), 11) / F.lit(float(1 << 53))

    key = ["source", "doc_id", "text_key", "size", "rows"]
    # repeats exchange among themselves first, which leaves one of them with a fraction
    sure = F.least(F.floor(F.col("rows") * F.col("fraction")), F.col("rows") - 1)
    open_rows = found.select(*key, (F.col("rows") * F.col("fraction") - sure).alias("x"), "docs")
    schema = "source string, doc_id long, text_key string, size long, rows long, x double, done boolean"
    most_docs = targets.agg(F.max("docs")).first()[0] or 0
    decided, group = None, fan
    while True:
        slots = F.ceil(F.col("docs") / F.lit(group))
        dealt = open_rows.withColumns(
            {
                "slot": F.pmod(F.xxhash64("doc_id", "text_key", F.lit(group)), slots),
                "last": slots == 1, "luck": draw(group),
            }
        )
        step = dealt.groupBy("source", "slot").applyInPandas(_reduce, schema)
        step = materialized(step, "pivot")
        ready = step.where("done").select(*key, F.col("x").cast("int").alias("extra"))
        decided = ready if decided is None else decided.unionByName(ready)
        if group >= most_docs:
            break
        counts = targets.select(F.col("source").alias("plan_source"), "docs")
        open_rows = step.where("not done").join(counts, F.col("source").eqNullSafe(F.col("plan_source")))
        open_rows = open_rows.select(*key, "x", "docs")
        group *= fan
    result = decided.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
    more = sure + F.col("extra")
    everyone = (more == F.col("rows")).cast("int")
    return result.select(
        *key, "source_size", "target", (F.col("whole") + everyone).alias("copies"),
        F.when(everyone == 1, F.lit(0)).otherwise(more).cast("bigint").alias("more"),
    )


def mixture(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    found = copies(docs, **options)
    # repeats are numbered in slices; where a row has several, they are dealt out before they are expanded
    slices = F.sequence(F.lit(0).cast("bigint"), F.shiftright(F.col("rows") - 1, SLICE_BITS))
    many = F.col("rows") > 1 << SLICE_BITS
    found = materialized(found, "mixture")
    spread = found.where(many).withColumn("_slice", F.explode(slices)).repartition("doc_id", "text_key", "_slice")
    found = found.where(~many).withColumn("_slice", F.lit(0).cast("bigint")).unionByName(spread)
    first = F.shiftleft(F.col("_slice"), SLICE_BITS)
    inside = F.sequence(first + 1, F.least(F.col("rows"), first + (1 << SLICE_BITS)))
    found = found.withColumn("_i", F.explode(inside))
    found = found.withColumn("copies", F.col("copies") + (F.col("_i") <= F.col("more")).cast("int"))
    taken = (F.col("copies") * F.col("size")).cast("bigint").alias("taken")
    return found.select("doc_id", "source", "size", "source_size", "target", "copies", taken)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, each as often as the mix takes it."""
    chosen = copies(docs, **options).where("copies > 0 or more > 0")
    chosen = materialized(
        chosen.select(
            F.col("doc_id").alias("_id"), F.col("source").alias("_src"), F.col("text_key").alias("_key"),
            F.col("copies").alias("_copies"), F.col("more").alias("_more"),
        ),
        "copies",
    )
    df = boxed(docs)
    key = F.md5(F.coalesce(F.col("_row.text"), F.lit("")))

    def matched(some: DataFrame) -> DataFrame:
        return df.join(
            some,
            F.col("_row.doc_id").cast("bigint").eqNullSafe(F.col("_id"))
            & F.col("_row.source").eqNullSafe(F.col("_src"))
            & (key == F.col("_key")),
        )

    uneven = chosen.where("_more > 0")
    found = matched(chosen.where("_more = 0")).select("_row", "_copies")
    if not uneven.isEmpty():
        found = found.unionByName(_uneven(matched(uneven)))
    found = found.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
    return found.select(*unboxed(found, docs.columns))


def _uneven(rows: DataFrame) -> DataFrame:
    """Rows (_row, _copies) of repeats: the first ``_more`` of a key have one copy more.

    Numbered inside slices of a stored table, then offset, so that no key goes through one task.
    """
    key = ["_id", "_src", "_key"]
    place = F.monotonically_increasing_id().alias("_place")
    placed = materialized(rows.select("_row", *key, "_copies", "_more", place), "repeats")
    placed = placed.withColumn("_part", F.shiftright("_place", SLICE_BITS))
    # one row per key and slice
    counts = placed.groupBy(*key, "_part").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy(*key).orderBy("_part")) - F.col("_n"))
    counts = counts.select(*[F.col(c).alias(f"{c}_of") for c in key], F.col("_part").alias("_part_of"), "_before")
    numbered = placed.withColumn("_nth", F.row_number().over(Window.partitionBy(*key, "_part").orderBy("_place")))
    same = F.col("_part") == F.col("_part_of")
    for c in key:
        same &= F.col(c).eqNullSafe(F.col(f"{c}_of"))
    extra = (F.col("_before") + F.col("_nth") <= F.col("_more")).cast("int")
    return numbered.join(counts, same).select("_row", (F.col("_copies") + extra).alias("_copies")).where("_copies > 0")

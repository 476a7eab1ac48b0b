"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewatch.session import materialized


def _rehung(links: DataFrame, larger: bool) -> DataFrame:
    """Hang the neighbours of each node on the least of them; all larger ones, or those up to the node."""
    if larger:
        sides = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = sides.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        moved = sides.where("b > a").join(near, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        near = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(near, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.unionAll(near.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) of any ordered type: rows (node, root), root the least node; roots are left out.

    Every step is stored in the shared folder; stars settle in a few steps, long chains in a number
    that grows with the logarithm of their length. Joins on a node with very many links are split by Spark.
    """
    links = materialized(links.where("a <> b").distinct(), "links")
    state = None
    while True:
        links = materialized(_rehung(links, larger=True), "links")
        links = materialized(_rehung(links, larger=False), "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
        if now == state or now[0] == 0:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now

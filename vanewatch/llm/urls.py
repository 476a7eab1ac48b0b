"""URL filters by a sort-merge range join, in SQL functions only.

A rule names a host and a path prefix and fits that host and its subdomains. Reversed hosts with a dot
behind them (``net.example.``) turn a rule's host into an interval of keys, and two such intervals are
nested or apart. One sorted sweep over the starts and ends of all rule hosts and the hosts of all URLs
keeps the stack of open intervals: a running depth, and for every level the interval opened last on it.
So a host gets all rule hosts above it, from the outermost to its own. A second sweep, over the paths
below each rule host, does the same with path prefixes: the innermost open prefix is the longest one that
fits. Of the winners on a URL's stack the longest rule wins.

Only distinct hosts and distinct pairs of host and path are swept, so equal URLs meet before any sort, and
their verdict is joined back to the rows. Sweeps are cut into slices where they are large: the first by
ranges of keys, with the running values carried from slice to slice (``operators.ordering``), the second
by dealing the paths of a rule host over slots, each with a copy of its rules.

A null URL or one without ``://`` has empty host and path and fits no rule. Equal URLs are judged row by
row, also with null ids; of two rules with equal host and path ``allow`` wins. Without rules, or for an
empty table, every URL gets the default verdict.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewatch.llm.frames import boxed
from vanewatch.operators.ordering import Before, running
from vanewatch.session import materialized

#: Keys that one task sweeps.
SLOT_ROWS = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _reversed(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """Rules as rows from (``allow`` or ``block``, ``host/path``)."""
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(r).alias("rule")) for v, r in rules]
    empty = F.array().cast("array<struct<verdict:string,rule:string>>")
    return spark.range(1).select(F.inline(F.array(*rows) if rows else empty))


def open_domains(hosts: DataFrame, domains: DataFrame, levels: int, rows_per_slice: int = SLOT_ROWS) -> DataFrame:
    """(host, domain): all rule domains that hold a host, by one sorted sweep; ``levels``: most labels of a domain.

    ``domain`` is reversed (``net.example``). A slash follows the dot in order, and no host has one: it ends
    the interval of a domain's keys.
    """
    nothing = F.lit(None).cast("string")
    host_key = F.concat(F.array_join(_reversed(F.col("host")), "."), F.lit("."))
    events = (
        domains.select(F.concat("domain", F.lit(".")).alias("key"), F.lit(0).alias("kind"), nothing.alias("host"))
        .unionByName(domains.select(F.concat("domain", F.lit("/")).alias("key"), F.lit(2).alias("kind"), nothing.alias("host")))
        .unionByName(hosts.select(host_key.alias("key"), F.lit(1).alias("kind"), "host"))
    )
    order = ["key", "kind"]
    events = materialized(events, "hosts")
    deep = running(events, [], order, {"_open": Before("sum", 1 - F.col("kind"))}, rows_per_slice)
    deep = materialized(deep.withColumn("_open", F.coalesce("_open", F.lit(0))), "depths")

    def opened(level: int) -> Before:
        """Keys rise, so the greatest start on a level so far is the one opened last."""
        return Before("max", F.when((F.col("kind") == 0) & (F.col("_open") == level), F.col("key")))

    stack = {f"_on{level}": opened(level) for level in range(levels)}
    visits = running(deep, [], order, stack, rows_per_slice).where("kind = 1 and _open > 0")
    found = visits.select("host", F.explode(F.slice(F.array(*stack), F.lit(1), F.col("_open").cast("int"))).alias("key"))
    return found.select("host", F.rtrim("key", F.lit(".")).alias("domain"))


def judged_urls(
    pages: DataFrame,
    rules: DataFrame,
    default: str = "allow",
    id_column: str = "page_id",
    url_column: str = "url",
    slot_rows: int = SLOT_ROWS,
) -> DataFrame:
    """One row per page: id, host, path, rule (null if none fits) and verdict; the longest rule wins."""
    url = F.col(f"_row.{url_column}")
    urls = boxed(pages.select(id_column, url_column)).select(
        F.col(f"_row.{id_column}").alias("id"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    known = (
        rules.select(
            "verdict", "rule",
            F.array_join(_reversed(F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER)), ".").alias("domain"),
            F.regexp_extract("rule", r"^[^/]*(.*)$", 1).alias("rule_path"),
        )
        .where("rule is not null and domain <> ''")
        .groupBy("domain", "rule_path")
        .agg(F.min(F.struct("verdict", "rule")).alias("found"))
        .select("domain", "rule_path", "found.*")
    )
    domains = known.select("domain").distinct()
    levels = domains.agg(F.max(F.size(F.split("domain", r"\.")))).first()[0] or 0
    if not levels:
        nothing = F.lit(None).cast("string").alias("rule")
        return urls.select(F.col("id").alias(id_column), "host", "path", nothing, F.lit(default).alias("verdict"))

    pairs = materialized(urls.where("host <> ''").select("host", "path").distinct(), "pairs")
    above = materialized(open_domains(pairs.select("host").distinct(), domains, levels, slot_rows), "open")
    keys = materialized(pairs.join(above, "host"), "keys")

    # hot domains: as many slots as their paths need
    slots = keys.groupBy("domain").agg(F.ceil(F.count(F.lit(1)) / F.lit(slot_rows)).alias("slots"))
    slots = materialized(slots, "slots")
    byte = F.lit(b"\xff")  # above every byte of a UTF-8 key
    none = {c: F.lit(None).cast("string").alias(c) for c in ("host", "path", "rule", "verdict")}
    visits = keys.join(slots, "domain").select(
        "domain", F.pmod(F.xxhash64("host", "path"), F.col("slots")).alias("slot"),
        F.col("path").cast("binary").alias("key"), F.lit(1).alias("kind"), "host", "path", none["rule"], none["verdict"],
    )
    dealt = known.join(slots, "domain")
    dealt = dealt.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slots") - 1)))
    start, where = F.col("rule_path").cast("binary"), (none["host"], none["path"])
    starts = dealt.select("domain", "slot", start.alias("key"), F.lit(0).alias("kind"), *where, "rule", "verdict")
    ends = dealt.select(
        "domain", "slot", F.concat(start, byte).alias("key"), F.lit(2).alias("kind"), *where, none["rule"], none["verdict"]
    )
    swept = visits.unionByName(starts).unionByName(ends).selectExpr(
        "*", "sum(1 - kind) over (partition by domain, slot order by key, kind rows unbounded preceding) as depth"
    )
    swept = swept.where("kind <> 2 and depth > 0").selectExpr(
        "*",
        """last(if(kind = 0, struct(length(rule) as size, length(domain) as host_size, rule, verdict), null), true)
           over (partition by domain, slot, depth order by key, kind rows unbounded preceding) as found""",
    )
    best = swept.where("kind = 1").groupBy("host", "path").agg(F.max("found").alias("found"))
    # stored, so that Spark can split the rows of a hot URL in the join
    best = materialized(best.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "found"), "verdicts")
    joined = urls.join(best, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")), "left")
    return joined.select(
        F.col("id").alias(id_column), "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), F.lit(default)).alias("verdict"),
    )

"""Exact de-duplication by content-defined chunk recipes, in SQL functions only.

Texts count as equal when they agree after deleting white space. A normalised text is cut into chunks
where its own content says so (after punctuation, at least LEAST characters after the last cut; a text
without punctuation is cut every MOST characters), so equal texts have equal chunks. A chunk gets a
64-bit identifier, verified over the whole table: an identifier under which two different SHA-256 sums
occur is not trusted, and the sums take its place. A document's recipe is its ordered list of
identifiers; equal recipes mean equal texts. Texts are read once; only identifiers, sums and lengths
move, however long the documents are.

Null text counts as empty, and empty texts are equal to each other. Among equal texts the one with the
most code points in the original text stays, then the smallest doc_id (null last), then the smallest
MD5 of the original; of rows that agree in all that, one stays. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewatch.llm.frames import SPACE, boxed, unboxed
from vanewatch.session import materialized

LEAST, MOST = 256, 4096
CUT = rf"(?s).{{{LEAST},{MOST}}}?[.,;:!?|]|.{{1,{MOST}}}"


def recipe_rows(docs: DataFrame, bits: int = 64) -> DataFrame:
    """One stored row per document: lengths, sums and chunks; ``bits`` shortens identifiers in tests."""
    original = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(
        F.col("doc_id"), F.regexp_replace(original, SPACE + "+", "").alias("plain"),
        F.length(original).cast("bigint").alias("points"), F.md5(original).alias("text_key"),
    )
    df = df.withColumn("pieces", F.regexp_extract_all("plain", F.lit(CUT), F.lit(0)))

    def identifier(piece: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(piece), 64 - bits) if bits < 64 else F.xxhash64(piece)

    df = df.select(
        "doc_id", "points", "text_key",
        F.sha2("plain", 256).alias("text_sha256"),
        F.transform("pieces", identifier).alias("recipe"),
        F.transform("pieces", lambda c: F.unhex(F.sha2(c, 256))).alias("sums"),
        F.monotonically_increasing_id().alias("place"),
    )
    return materialized(df, "recipes")


def untrusted(rows: DataFrame) -> DataFrame:
    """Identifiers that stand for more than one chunk."""
    chunks = rows.select(F.explode(F.arrays_zip("recipe", "sums")).alias("c")).select("c.*")
    found = chunks.groupBy("recipe").agg(F.min("sums").alias("a"), F.max("sums").alias("b"))
    return found.where("a <> b").select("recipe")


def exact_groups(docs: DataFrame, bits: int = 64) -> DataFrame:
    """One row per document: doc_id, text_key, keep_id, group_size, kept, text_sha256.

    The group table is joined back on recipes; Spark splits the rows of a group with very many copies.
    """
    rows = recipe_rows(docs, bits)
    same = ["recipe"] if untrusted(rows).isEmpty() else ["recipe", "sums"]
    order = F.struct(
        (-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("missing"), "doc_id", "text_key", "place"
    )
    groups = rows.groupBy(*same).agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.select(*same, "best.place", F.col("best.doc_id").alias("keep_id"), "group_size")
    # stored, so that both sides of the join are plain shuffles, of which Spark can split hot parts
    groups = materialized(groups.withColumnRenamed("place", "best_place"), "groups")
    joined = rows.select("doc_id", "text_key", "text_sha256", "place", *same).join(groups, same)
    return joined.select(
        "doc_id", "text_key", "keep_id", "group_size",
        (F.col("place") == F.col("best_place")).alias("kept"), "text_sha256",
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    groups = materialized(exact_groups(docs), "exact-groups")
    kept = groups.where("kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    df = boxed(docs)
    key = F.md5(F.coalesce(F.col("_row.text"), F.lit("")))
    df = df.join(kept, F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (key == F.col("_key")), "left_semi")
    if not groups.groupBy("doc_id", "text_key").count().where("count > 1").isEmpty():
        # rows repeated in doc_id and text: any one of them stands for all
        df = df.withColumns({"_id": F.col("_row.doc_id"), "_key": key}).dropDuplicates(["_id", "_key"])
    return df.select(*unboxed(df, docs.columns))

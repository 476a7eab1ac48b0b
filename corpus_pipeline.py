"""From raw documents to packed sequences: filter, de-duplicate, mix, pack.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again as
the documents of the next stage. All stages but the last return the columns of ``documents``, further ones
included; the mix repeats a document as often as it is taken. Ids, languages and sources may be null, which
is a value like any other; an empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vanewatch.llm import chunks, jaccard, mixing, packing, rules
from vanewatch.llm.queries import VOCABULARY
from vanewatch.session import materialized


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    Null and empty texts and texts of fewer than 20 words go. Repeated rows are judged one by one and stay
    or go together; long texts are judged whole.
    """
    return rules.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space one stays.

    The longest original stays, then the smallest id, null last; of rows that agree in both one stays. Null
    counts as empty, and empty texts are equal.
    """
    return chunks.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by links (five-word shingles, similarity 0.8 or more) one stays.

    The smallest id stays, null last. Texts without a word are linked with nothing and all stay; shorter ones
    than five words are one shingle. Of rows that agree in id and text one stays.
    """
    return jaccard.keep_one(docs, size=5, percent=80)


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, once or twice.

    A null source is a source. Texts without a word weigh nothing: they are taken like others of their source
    and change no total. Of repeated rows some are taken once more than the others.
    """
    return mixing.mixed(docs, weights=(5, 2, 1), share=1.5, most=2.0)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 4096 tokens.

    Null and empty texts are one token, the end mark; repeated rows are packed one by one; longer documents
    than a sequence are cut into pieces.
    """
    return packing.packed(docs, VOCABULARY, capacity=4096, end_id=1, keep_ids=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing_to_weights),
    ("packing", best_fit_packing),
]

#: Near-duplicates, mixing and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

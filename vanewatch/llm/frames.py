"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]"
#: Characters of text that a Python task turns into arrays at once.
CHARS_AT_ONCE = 1_000_000


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("bigint")


def boxed(df: DataFrame, name: str = "_row") -> DataFrame:
    """All columns as one struct, so that working columns cannot clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def unboxed(df: DataFrame, columns: Iterable[str], name: str = "_row") -> list[Column]:
    return [F.col(name).getField(c).alias(c) for c in columns]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_pieces(
    batches: Iterable[pa.RecordBatch], text: str, most: int = CHARS_AT_ONCE
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches so that the texts of a piece hold about ``most`` characters (one row at least)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        start = 0
        while start < batch.num_rows:
            texts: list[str] = []
            size = 0
            while start + len(texts) < batch.num_rows:
                value = column[start + len(texts)].as_py() or ""
                if texts and size + len(value) > most:
                    break
                texts.append(value)
                size += len(value)
            yield batch.slice(start, len(texts)), texts
            start += len(texts)

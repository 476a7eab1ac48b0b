"""Files of token ids in document order, with random access to any token.

Documents are range-partitioned by id, sorted, tokenised and written as shards of directly addressable
codes (``addressable``), several documents to a shard, none cut. A shard is one file that Spark's writer
commits, so a lost executor leaves no half file and the folder may be in any store that Spark reads. Its
layout, little-endian: ``DACT``, crc32 of what follows, documents, partition, number in the partition
(five 32-bit words with the mark), then ids (int64), null flags (int8) and token counts (int64) of the
documents, then the codes. One line feed follows.

Order is by id, nulls last; rows of one id are ordered by the MD5 of their text, equal rows anyhow. A hot
id is spread over partitions. Null text is empty: one token, the end mark, if there is one. Shards hold
about ``shard_tokens`` tokens; a longer document has a shard to itself. Other columns are not read. An
empty table gives an empty folder and no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vanewatch.llm import textarrays as ta
from vanewatch.llm.addressable import Codes
from vanewatch.llm.frames import in_pieces
from vanewatch.llm.packing import Encoder
from vanewatch.session import materialized

MARK = b"DACT"
HEAD = "<4sIIII"
SHARD_TOKENS = 1 << 22
_AT_ONCE = 1 << 18
DOCUMENTS = "part int, number int, id long, inside long, n_tokens long, ids_crc32 long"


class Shard:
    """One file's content; ``codes.take`` gives the token at any place."""

    def __init__(self, content: bytes):
        mark, crc, n, self.part, self.number = struct.unpack_from(HEAD, content)
        at = struct.calcsize(HEAD)
        if mark != MARK or zlib.crc32(memoryview(content)[8:-1]) != crc:
            raise ValueError("not a whole file of token ids")
        self.ids = np.frombuffer(content, "<i8", n, at)
        self.null = np.frombuffer(content, np.int8, n, at + 8 * n).astype(bool)
        self.lengths = np.frombuffer(content, "<i8", n, at + 9 * n)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.codes = Codes.from_bytes(content, at + 17 * n)

    @staticmethod
    def to_bytes(part: int, number: int, ids: list[int | None], rows: list[np.ndarray]) -> bytes:
        parts = (
            struct.pack("<III", len(ids), part, number),
            np.array([i or 0 for i in ids], "<i8").tobytes(),
            np.array([i is None for i in ids], np.int8).tobytes(),
            np.array([len(r) for r in rows], "<i8").tobytes(),
            Codes.of(np.concatenate(rows)).to_bytes(),
        )
        crc = 0
        for p in parts:
            crc = zlib.crc32(p, crc)
        return b"".join((MARK, struct.pack("<I", crc), *parts))

    def documents(self) -> pa.RecordBatch:
        """Rows of DOCUMENTS; tokens are read some documents at a time."""
        crc, ends, k = np.zeros(len(self.ids), np.int64), self.starts + self.lengths, 0
        while k < len(self.ids):
            until = max(int(np.searchsorted(ends, self.starts[k] + _AT_ONCE, side="right")), k + 1)
            tokens = self.codes.between(int(self.starts[k]), int(ends[until - 1])).astype("<u4", copy=False)
            for i in range(k, until):
                at = self.starts[i] - self.starts[k]
                crc[i] = zlib.crc32(tokens[at : at + self.lengths[i]])
            k = until
        n = len(self.ids)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, self.part, np.int32)), pa.array(np.full(n, self.number, np.int32)),
                pa.array(self.ids, pa.int64(), mask=self.null), pa.array(self.starts, pa.int64()),
                pa.array(self.lengths, pa.int64()), pa.array(crc),
            ],
            ["part", "number", "id", "inside", "n_tokens", "ids_crc32"],
        )


def write(
    docs: DataFrame, path: str, folder: str, end_id: int | None = 2, shard_tokens: int = SHARD_TOKENS,
    id_column: str = "doc_id",
) -> None:
    """Write the ids of all documents to ``folder``, which must not exist."""
    spark = docs.sparkSession
    end = np.array([] if end_id is None else [end_id], np.uint32)

    def shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ta.once(("encoder", path), lambda: Encoder(path))
        part, number = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        rows: list[np.ndarray] = []
        held = 0

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([Shard.to_bytes(part, number, ids, rows)], pa.binary())], ["shard"])

        for batch, texts in in_pieces(batches, "text"):
            for i, row in zip(batch.column(0).to_pylist(), encoder.encode(texts), strict=True):
                row = np.append(row, end).astype(np.uint32)
                if rows and held + len(row) > shard_tokens:
                    yield flushed()
                    ids, rows, held, number = [], [], 0, number + 1
                ids.append(i)
                rows.append(row)
                held += len(row)
        if rows:
            yield flushed()

    thin = docs.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("tie"),
        F.monotonically_increasing_id().alias("spread"),
    )
    order = [F.col("id").asc_nulls_last(), "tie", "spread"]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = thin.repartitionByRange(partitions, *order).sortWithinPartitions(*order).select("id", "text")
    # the text writer puts the bytes of a string as they are; a row is a file
    content = ordered.mapInArrow(shards, "shard binary").select(F.col("shard").cast("string").alias("shard"))
    content.write.option("maxRecordsPerFile", 1).text(folder)


def contents(spark: SparkSession, folder: str) -> DataFrame:
    """The files, a row each."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.where("length > 0").select("content")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Rows from the files: part, number, id, start, inside (place in its file), n_tokens, ids_crc32."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                yield Shard(value.as_py()).documents()

    rows = materialized(contents(spark, folder).mapInArrow(read, DOCUMENTS), "directory")
    files = rows.groupBy("part", "number").agg(F.sum("n_tokens").alias("n"))
    files = files.withColumn("before", F.sum("n").over(Window.partitionBy("part").orderBy("number")) - F.col("n"))
    # one row per partition of the writer
    parts = files.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    starts = files.join(parts, "part").select("part", "number", (F.col("before") + F.col("base")).alias("first"))
    joined = rows.join(materialized(starts, "starts"), ["part", "number"])
    return joined.select("part", "number", "id", (F.col("first") + F.col("inside")).alias("start"), "inside", "n_tokens", "ids_crc32")


def tokens_at(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """Single tokens: for rows (id, place) also the token there; no row for places that do not exist.

    Only the wanted tokens of a file are read; a file is asked for each of its places once at most. Of
    several documents with one id each answers.
    """
    places = wanted.select(F.col("id"), F.col("place").cast("bigint").alias("place")).distinct()
    rows = documents(spark, folder).withColumnRenamed("id", "of")
    found = places.join(rows, F.col("id").eqNullSafe(F.col("of")) & (F.col("place") >= 0) & (F.col("place") < F.col("n_tokens")))
    found = found.select("part", "number", "id", "place", (F.col("inside") + F.col("place")).alias("at"))

    def with_keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                _, _, _, part, number = struct.unpack_from(HEAD, value.as_py())
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()), "content": [value]})

    def answer(asked: pd.DataFrame, files: pd.DataFrame) -> pd.DataFrame:
        tokens = Shard(files["content"].iloc[0]).codes.take(asked["at"].to_numpy()) if len(asked) else []
        return pd.DataFrame({"id": asked["id"].astype("Int64"), "place": asked["place"], "token": np.asarray(tokens, np.int64)})

    files = contents(spark, folder).mapInArrow(with_keys, "part int, number int, content binary")
    key = ["part", "number"]
    return found.groupBy(*key).cogroup(files.groupBy(*key)).applyInPandas(answer, "id long, place long, token long")

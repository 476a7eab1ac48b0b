"""Packing documents into sequences by minimum bin slack.

Each document is tokenised whole; one longer than a sequence is cut into full pieces and a rest. Bins
are planned from the counts per length, of which there are at most ``capacity``: a bin starts with the
longest piece left, and a subset-sum over the other lengths that are left (dynamic programming on a
bit set, each length as often as there are pieces) finds the fullest combination with it. The
combination is taken out as many times as its pieces last, so the plan has a few rows per length
however many documents there are: a length that runs out does so with a smaller multiple each time,
which bounds the combinations by the sum of capacity / length. Pieces are numbered by length with a
range-partitioned sort, and the plan's ranges of numbers say where each piece goes.

Null text is an empty document of one token, the end mark. Repeated rows are packed one by one, null
ids too. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewatch.llm import textarrays as ta
from vanewatch.llm.alphabet import alphabet
from vanewatch.llm.frames import in_pieces
from vanewatch.llm.mixing import ranked
from vanewatch.llm.tokens import Memory, merges, pretokens
from vanewatch.session import materialized

PIECES = "piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Ids of whole texts; the library encodes a distinct pre-token once, the worker remembers its ids."""

    def __init__(self, path: str):
        self.letters = alphabet(path)
        self.special = merges(path).split
        self.ids = np.zeros(0, np.uint32)
        self._forget()

    def _forget(self) -> None:
        #: by hash: the place in start and length, which tell where the ids are
        self.memory = Memory()
        self.start = self.length = np.zeros(0, np.int64)
        self.ids, self.used = self.ids[:0], 0

    def _keep(self, rows: list[list[int]]) -> np.ndarray:
        length = np.array([len(r) for r in rows], np.int64)
        flat = np.array([i for r in rows for i in r], np.uint32)
        start = self.used + np.cumsum(length) - length
        if self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(max(self.used, len(flat) * 4), np.uint32)])
        self.ids[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        place = len(self.start) + np.arange(len(rows))
        self.start, self.length = np.append(self.start, start), np.append(self.length, length)
        return place

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts = [self.letters.folded(t) for t in texts]
        points, starts = ta.code_points(parts)
        begin, end = pretokens(points, starts, self.letters.kinds(points))
        rows: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        if len(begin):
            hashes = ta.run_hashes(ta.prefix_sums(points), begin, end)
            distinct, example, which = np.unique(hashes, return_index=True, return_inverse=True)
            if len(self.memory.hashes) + len(distinct) > self.memory.most:
                self._forget()
            value, unknown = self.memory.find(distinct)
            if unknown.any():
                joined = "".join(parts)
                words = [joined[begin[i] : end[i]] for i in example[unknown]]
                coded = self.letters.plain.encode_batch(words, add_special_tokens=False)
                value[unknown] = self._keep([c.ids for c in coded])
                self.memory.add(distinct[unknown], value[unknown])
            length = self.length[value][which]
            flat = self.ids[ta.gathered(self.start[value][which], length)]
            sums = np.concatenate([[0], np.cumsum(length)])
            bounds = sums[np.searchsorted(begin, starts)]
            rows = [flat[bounds[i] : bounds[i + 1]] for i in range(len(texts))]
        for i, text in enumerate(texts):
            if ("<" in text and self.special.search(text)) or len(text) >= 1 << 20:
                rows[i] = np.array(self.letters.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return rows


def pieces(
    docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, keep_ids: bool = True,
    id_column: str = "doc_id",
) -> DataFrame:
    """Stored rows: id, piece, start, length, ids_crc32 and, if wanted, the ids themselves."""
    kind = dict(docs.dtypes)[id_column]

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ta.once(("encoder", path), lambda: Encoder(path))
        for batch, texts in in_pieces(batches, "text"):
            owner, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, row in enumerate(encoder.encode(texts)):
                row = np.append(row, np.uint32(end_id)).astype("<u4")
                for k, at in enumerate(range(0, len(row), capacity)):
                    part = row[at : at + capacity]
                    owner.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    ids.append(part.astype(np.int32) if keep_ids else None)
            columns = [
                batch.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
            ]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, ["id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    thin = docs.select(F.col(id_column).alias("id"), F.col("text").alias("text"))
    return materialized(thin.mapInArrow(cut, f"id {kind}, {PIECES}" + ", ids array<int>" * keep_ids), "pieces")


def fullest(left: dict[int, int], capacity: int) -> dict[int, int]:
    """Of the lengths left: the longest, and with it the fullest combination that fits; length to multiple."""
    lengths = sorted(left, reverse=True)
    longest = lengths[0]
    chosen = {longest: 1}
    room = capacity - longest
    whole, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in lengths:
        if length > room:
            continue
        have = min(left[length] - (length == longest), room // length)
        take = 1
        while have > 0 and not reach >> room & 1:
            take = min(take, have)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & whole
            have -= take
            take *= 2
        if reach >> room & 1:
            break
    fill = reach.bit_length() - 1
    for length, take, before in reversed(steps):
        if not before >> fill & 1:
            chosen[length] = chosen.get(length, 0) + take
            fill -= length * take
    return chosen


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first, last, times, sequence, offset).

    Of the pieces of a length, numbers first to last - 1 go to the sequences from ``sequence`` on,
    ``times`` to each, from ``offset`` on.
    """
    left = {k: n for k, n in counts.items() if n > 0}
    taken = dict.fromkeys(left, 0)
    rows, sequence = [], 0
    while left:
        chosen = fullest(left, capacity)
        bins = min(left[k] // n for k, n in chosen.items())
        offset = 0
        for length, times in chosen.items():
            first = taken[length]
            taken[length] += bins * times
            rows.append((length, first, taken[length], times, sequence, offset))
            offset += length * times
            left[length] -= bins * times
            if not left[length]:
                del left[length]
        sequence += bins
    return rows


def packed(
    docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, keep_ids: bool = True,
    id_column: str = "doc_id",
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    spark = docs.sparkSession
    cut = pieces(docs, path, capacity, end_id, keep_ids, id_column)
    # one row a length: at most ``capacity``
    counts = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}
    before, total = {}, 0
    for length in sorted(counts):
        before[length] = total
        total += counts[length]
    rows = [(k, before[k] + a, before[k] + b, n, s, o) for k, a, b, n, s, o in plan(counts, capacity)]
    names = ["plan_length", "first", "last", "times", "sequence", "place"]
    table = spark.createDataFrame(pd.DataFrame(rows, columns=names, dtype="int64"), ", ".join(f"{n} long" for n in names))
    thin = [c for c in cut.columns if c != "ids"]
    numbered = ranked(cut, "length", *[c for c in thin if c != "length"])
    here = F.col("rank") - F.col("first")
    # bounded by capacity and not by the documents: see above
    joined = numbered.join(
        F.broadcast(table),
        (F.col("length") == F.col("plan_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")),
    )
    return joined.select(
        F.col("id").alias(id_column), "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.floor(here / F.col("times"))).alias("sequence_id"),
        (F.col("place") + F.pmod(here, F.col("times")) * F.col("length")).alias("offset"),
        *(["ids"] if keep_ids else []),
    )

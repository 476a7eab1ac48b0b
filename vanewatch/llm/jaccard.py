"""Near-duplicate join of documents by the Jaccard similarity of word shingles.

1. Documents with equal shingle sets form one class.
2. Classes that may link meet in the block of the least of them. For thresholds from NARROW on: sets that
   link differ in few shingles, d at most for their size. Hashes are cut into d + 1 ranges, so in one range
   at least linked sets are equal, and classes with an equal range meet. Sizes are dealt into bands of one
   d each; a class close below a band takes part in it too. Below NARROW such ranges would hold too few
   shingles to tell texts apart; there, a set of n shingles shares one of its n - ceil(t n) + 1 rarest with
   a set that it links to, and classes of like size with an equal one meet. Rare is what a count sketch of
   all shingles says (a table of fixed size, summed over all documents); any order would give all links.
3. Inside a block links are found by T-occurrence search (DivideSkip) on its inverted lists: the short
   lists of a query are heap-merged, the long ones binary-probed for what the merge found, and classes
   with the overlap that the threshold needs are linked. A class is only searched for while some link
   could still join two parts. Blocks with very many shingles are dealt over parts; then only classes
   that are not yet joined to the block's least one meet the other parts.
4. Links form components. Every pair above the threshold is found or already joined; no partner,
   candidate or list is capped.

Shingles are compared by hashes (48 bits inside a block), whole sets by 64-bit sums of all of them. Null, empty and blank
texts have no shingles and are linked with nothing; a text shorter than a shingle is one shingle. Rows
with equal texts are linked; null ids take part but are never a component's smallest id. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewatch.llm import textarrays as ta
from vanewatch.llm.components import components
from vanewatch.llm.frames import boxed, in_pieces, unboxed
from vanewatch.session import materialized

#: From this threshold on classes meet by ranges, below by rare shingles.
NARROW = 85
#: Cells of the count sketch, and rows that carry it.
CELLS, SLICES = 1 << 22, 16
#: Sizes of a band: up to so many times the threshold's ratio.
BAND = 4
#: Bits of the map of classes that meet others.
BITS = 1 << 23
#: Shingles of one part of a block (32 MB of hashes).
PART = 4_000_000
#: Hits in short lists that a candidate must have, if its threshold allows so many.
HITS = 3
_BLANK = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    points, starts = ta.code_points(texts)
    if not len(points):
        return [np.zeros(0, np.uint64)] * len(texts)
    upper = (points >= 65) & (points <= 90)
    points = points + upper.astype(np.uint32) * np.uint32(32)
    blank = np.zeros(33, bool)
    blank[list(_BLANK)] = True
    gap = blank[np.minimum(points, 32)] & (points <= 32)
    begin, end = ta.runs(gap.astype(np.uint8), starts)
    words = ~gap[begin]
    begin, end = begin[words], end[words]
    word = ta.run_hashes(ta.prefix_sums(points), begin, end)
    cuts = np.searchsorted(begin, starts)
    n = max(len(word) - size + 1, 0)
    shingle = np.zeros(n, np.uint64)
    for k in range(size):
        shingle = ta.mix(shingle + word[k : k + n] * np.uint64(2 * k + 3))
    found = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b - a >= size:
            row = np.sort(shingle[a : b - size + 1])
            fresh = np.ones(len(row), bool)
            fresh[1:] = row[1:] != row[:-1]
            found.append(row[fresh])
        elif b > a:
            found.append(short(word[a:b]))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def short(word: np.ndarray) -> np.ndarray:
    """The one shingle of a text with fewer words than a shingle has."""
    value = np.full(1, len(word), np.uint64)
    for k in range(len(word)):
        value = ta.mix(value * np.uint64(2 * k + 3) + word[k])
    return value


def set_key(row: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(row.tobytes(), digest_size=8).digest(), "little", signed=True)


def stored(row: np.ndarray) -> bytes:
    """A sorted set in six bytes a hash."""
    row = row >> np.uint64(16)
    return (row >> np.uint64(32)).astype("<u2").tobytes() + row.astype("<u4").tobytes()


def restored(body: bytes) -> np.ndarray:
    n = len(body) // 6
    high, low = np.frombuffer(body, "<u2", n), np.frombuffer(body, "<u4", n, 2 * n)
    return high.astype(np.uint64) << np.uint64(32) | low


def ranges_of(row: np.ndarray, percent: int) -> np.ndarray:
    """Keys of a set's hash ranges, in its own band of sizes and in the next if a larger set there may link."""
    n, width = len(row), BAND * np.log(100 / percent)
    band = int(np.floor(np.log(n) / width + 1e-9))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ta.mix(row))])
    found = []
    for k in (band, band + 1):
        low, high = np.exp(k * width), np.exp((k + 1) * width)
        if n < low * percent / 100 - 1e-6:
            continue
        count = int(2 * high * (100 - percent) / (100 + percent) + 1e-6) + 1
        edge = np.searchsorted((row >> np.uint64(32)) * np.uint64(count) >> np.uint64(32), np.arange(count + 1))
        place = ta.mix(np.arange(count, dtype=np.uint64) + np.uint64((k + 1) << 40))
        found.append(ta.mix(sums[edge[1:]] - sums[edge[:-1]] + place))
    return np.concatenate(found)


def rarest(row: np.ndarray, cells: np.ndarray, percent: int) -> np.ndarray:
    """The shingles of which a linked set must share one: the first by sketch count, then hash."""
    n = len(row) - -(-len(row) * percent // 100) + 1
    count = cells[(row >> np.uint64(42)).astype(np.int64)]
    return row[np.lexsort((row, count))[:n]]


def sketch(docs: DataFrame, size: int) -> np.ndarray:
    """Shingle counts of all documents by the top bits of the hash; a table of fixed size."""
    width = CELLS // SLICES

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.int32)
        for _, texts in in_pieces(batches, "text"):
            for row in shingle_sets(texts, size):
                np.add.at(cells, (row >> np.uint64(42)).astype(np.int64), 1)
        # a task's counts stop at 255: the order stays one order, and frequent shingles stay last
        parts = np.minimum(cells, 255).astype(np.uint8).reshape(SLICES, width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["part", "cells"]
        )

    def add(key: tuple, table: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, np.int64)
        for cells in table["cells"]:
            total += np.frombuffer(cells, np.uint8)
        return pd.DataFrame({"part": [key[0]], "cells": [total.astype("<u4").tobytes()]})

    partial = docs.select("text").mapInArrow(count, "part int, cells binary")
    rows = partial.groupBy("part").applyInPandas(add, "part int, cells binary").collect()  # CELLS numbers
    cells = np.zeros((SLICES, width), np.uint32)
    for row in rows:
        cells[row["part"]] = np.frombuffer(row["cells"], "<u4")
    return cells.reshape(-1)


def signatures(docs: DataFrame, size: int, percent: int, id_column: str) -> DataFrame:
    """Stored rows: id, text_key, n_shingles, key of the set (null if empty), places where it meets others."""
    kind = dict(docs.dtypes)[id_column]
    cells = None if percent >= NARROW else docs.sparkSession.sparkContext.broadcast(sketch(docs, size))

    def places(row: np.ndarray) -> np.ndarray:
        found = ranges_of(row, percent) if cells is None else rarest(row, cells.value, percent)
        return found.astype(np.int64)

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in in_pieces(batches, "text"):
            rows = shingle_sets(texts, size)
            keys = [set_key(r) if len(r) else None for r in rows]
            found = [places(r) if len(r) else [] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2), pa.array([len(r) for r in rows], pa.int64()), pa.array(keys, pa.int64()),
                    pa.array(found, pa.list_(pa.int64())),
                ],
                ["id", "text_key", "n_shingles", "key", "places"],
            )

    text_key = F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("text_key")
    thin = docs.select(F.col(id_column).alias("id"), F.col("text").alias("text"), text_key)
    schema = f"id {kind}, text_key string, n_shingles long, key long, places array<bigint>"
    return materialized(thin.mapInArrow(sign, schema), "signatures")


def _met(rows: DataFrame, *at: str) -> DataFrame:
    """Rows of the places where several classes are, with the least class of each place as ``hub``."""
    hubs = rows.groupBy(*at).agg(F.min("key").alias("hub"), F.max("key").alias("last")).where("hub <> last")
    # stored, so that both sides of the join are plain shuffles, of which Spark can split hot places
    return rows.join(materialized(hubs.drop("last"), "hubs"), list(at))


def meetings(signed: DataFrame, percent: int) -> DataFrame:
    """Stored rows (hub, key, n): classes that share a place, under the least class that has it.

    Least and greatest class of a place are partial aggregates. Of classes with a rare shingle in common only those of like size meet: bands of sizes one threshold wide,
    each class in its own band and the next.
    """
    rows = signed.where("key is not null").select(
        F.explode("places").alias("place"), "key", F.col("n_shingles").cast("int").alias("n")
    )
    met = _met(rows, "place")
    if percent < NARROW:
        shared = materialized(met.select("place", "key", "n").distinct(), "shared")
        band = F.floor(F.log("n") / F.lit(np.log(100 / percent) * 1.000001)).cast("int")
        met = _met(shared.withColumn("band", F.explode(F.array(band, band + 1))), "place", "band")
    return materialized(met.select("hub", "key", "n").distinct(), "meetings")


def class_map(met: DataFrame) -> bytes:
    """A bit for the remainder of each class that meets others; a table of BITS bits."""
    place = F.pmod("key", F.lit(BITS)) + 1
    rows = met.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    found = bytearray(BITS // 8)
    for row in rows.collect():  # 4 KB each, BITS in all
        at = (row["bucket"] - 1) * 4096
        found[at : at + 4096] = row["bits"]
    return bytes(found)


def sets_of(docs: DataFrame, met: DataFrame, size: int) -> DataFrame:
    """Rows (key, shingles) of the classes that meet others; the map skips most other texts.

    A class comes once from each task that has it.
    """
    wanted = docs.sparkSession.sparkContext.broadcast(class_map(met))

    def collect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = np.frombuffer(wanted.value, np.uint8), set()
        for _, texts in in_pieces(batches, "text"):
            keys, sets = [], []
            for row in shingle_sets(texts, size):
                if len(row):
                    key = set_key(row)
                    at = key % BITS
                    if bits[at >> 3] >> (at & 7) & 1 and key not in seen:
                        seen.add(key)
                        keys.append(key)
                        sets.append(stored(row))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], ["key", "shingles"])

    return docs.select("text").mapInArrow(collect, "key long, shingles binary")


class Block:
    """Inverted lists over the sets of a block, and the parts that links have joined so far."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.percent, self.n = percent, len(sets)
        flat, owner = np.concatenate(sets), np.repeat(np.arange(self.n), self.sizes)
        order = np.argsort(flat, kind="stable")
        ordered = flat[order]
        fresh = np.ones(len(flat), bool)
        fresh[1:] = ordered[1:] != ordered[:-1]
        number = np.cumsum(fresh) - 1
        self.list_of = np.empty(len(flat), np.int64)
        self.list_of[order] = number
        self.members = owner[order]
        self.start = np.append(np.flatnonzero(fresh), len(flat))
        self.length = np.diff(self.start)
        #: sorted: number of the list times n plus the member
        self.entries = number * self.n + self.members
        self.offset = np.cumsum(self.sizes) - self.sizes
        self.part = np.arange(self.n)

    def linked(self, query: int) -> np.ndarray:
        """All members that link with one, but for those already joined to it."""
        size = self.sizes[query]
        lists = self.list_of[self.offset[query] : self.offset[query] + size]
        lists = lists[np.argsort(self.length[lists], kind="stable")]
        least = -(-int(size) * self.percent // 100)
        hits = min(least, HITS)
        long_lists = lists[size - (least - hits) :]
        short = [self.members[self.start[k] : self.start[k + 1]].tolist() for k in lists[: size - (least - hits)] if self.length[k] > 1]
        merged = Counter(heapq.merge(*short))
        found = np.array([m for m, n in merged.items() if n >= hits - 1], np.int64)
        count = np.array([merged[m] for m in found.tolist()], np.int64)
        near = (self.part[found] != self.part[query]) & (count >= hits)
        smaller, larger = np.minimum(self.sizes[found], size), np.maximum(self.sizes[found], size)
        near &= 100 * smaller >= self.percent * larger
        found, count = found[near], count[near]
        if not len(found):
            return found
        if len(long_lists):
            probe = long_lists[:, None] * self.n + found[None, :]
            place = np.minimum(np.searchsorted(self.entries, probe), len(self.entries) - 1)
            count = count + (self.entries[place] == probe).sum(axis=0)
        union = size + self.sizes[found] - count
        return found[100 * count >= self.percent * union]

    def join_all(self) -> np.ndarray:
        """Search until every pair was searched for or lies in one part; the part of each member."""
        open_ = np.ones(self.n, bool)
        while True:
            sizes = np.bincount(self.part[open_], minlength=self.n)
            outside = np.flatnonzero(open_ & (self.part != sizes.argmax()))
            if not len(outside):
                return self.part
            query = int(outside[0])
            open_[query] = False
            for other in self.linked(query).tolist():
                a, b = self.part[query], self.part[other]
                if a != b:
                    self.part[self.part == max(a, b)] = min(a, b)


def _links(percent: int):
    """Rows (block, key, shingles), equal blocks together, to links (a, b) of the joined classes."""

    def solve(sets: dict[int, bytes]) -> list[tuple[int, int]]:
        if len(sets) < 2:
            return []
        keys = sorted(sets)
        part = Block([restored(sets[k]) for k in keys], percent).join_all()
        return [(keys[i], keys[p]) for i, p in enumerate(part.tolist()) if i != p]

    def batch_of(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        columns = [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, ["a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, sets, pairs = None, {}, []
        for batch in batches:
            for name, key, shingles in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if name != block:
                    pairs += solve(sets)
                    block, sets = name, {}
                sets[key] = shingles
            yield batch_of(pairs)
            pairs = []
        yield batch_of(solve(sets))

    return run


def _solved(dealt: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of rows (block, key): sets are joined on, blocks brought together and solved one by one."""
    rows = dealt.join(sets, "key").select("block", "key", "shingles")
    rows = rows.repartition("block").sortWithinPartitions("block")
    return materialized(rows.mapInArrow(_links(percent), "a long, b long"), "block-links")


def links(docs: DataFrame, met: DataFrame, size: int, percent: int, part: int = PART) -> DataFrame:
    """Links (a, b) between classes that join exactly what all links above the threshold join."""
    sets = sets_of(docs, met, size)
    parts = met.groupBy("hub").agg(F.ceil(F.sum("n") / F.lit(part)).alias("parts"))
    dealt = met.join(parts, "hub").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
    # the least class is in every part of its block
    copies = parts.where("parts > 1").select("hub", F.col("hub").alias("key"), every.alias("part"))
    inside = dealt.select("hub", "key", "part").unionByName(copies).distinct()
    found = _solved(inside.select(F.concat_ws(":", "hub", "part").alias("block"), "key"), sets, percent)
    split = materialized(dealt.where("parts > 1").select("hub", "key", "parts", "part"), "split")
    if split.isEmpty():
        return found
    joined = materialized(components(found), "joined")
    placed = split.join(joined.withColumnRenamed("node", "key"), "key", "left")
    own = joined.select(F.col("node").alias("hub"), F.col("root").alias("hub_root"))
    placed = placed.join(own, "hub", "left")
    outside = placed.where(F.coalesce("root", "key") != F.coalesce("hub_root", "hub"))
    outside = materialized(outside.select("hub", "key", "parts", "part"), "outside")
    # a part's classes outside meet every part of the block once
    visits = outside.withColumn("other", every)
    meets = outside.select("hub", "part").distinct()
    rest = split.select("hub", "key", F.col("part").alias("other")).join(meets, "hub")
    across = visits.select("hub", "part", "other", "key").unionByName(rest.select("hub", "part", "other", "key")).distinct()
    across = across.select(F.concat_ws(":", "hub", "part", "other").alias("block"), "key")
    return found.unionByName(_solved(across, sets, percent))


def rooted(docs: DataFrame, size: int, percent: int, id_column: str = "doc_id", part: int = PART) -> DataFrame:
    """Stored rows: id, text_key, n_shingles, root (null without shingles) of each document."""
    signed = signatures(docs, size, percent, id_column)
    joined = components(links(docs, meetings(signed, percent), size, percent, part))
    known = signed.select("id", "text_key", "n_shingles", "key")
    rows = known.join(joined, known["key"] == joined["node"], "left")
    return materialized(rows.select("id", "text_key", "n_shingles", F.coalesce("root", "key").alias("root")), "rooted")


def linked_components(
    docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", part: int = PART
) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id of the component)."""
    rows = rooted(docs, size, percent, id_column, part)
    # stored, so that both sides of the join are plain shuffles, of which Spark can split hot parts
    least = materialized(rows.where("root is not null").groupBy("root").agg(F.min("id").alias("least")), "least")
    return rows.join(least, "root", "left").select(
        F.col("id").alias(id_column), "n_shingles",
        F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"),
    )


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, with all its columns: smallest id, null last, then smallest MD5.

    Documents without shingles all stay. Of rows that agree in id and text one stays.
    """
    rows = rooted(docs, size, percent)
    order = F.struct(F.col("id").isNull().alias("missing"), "id", "text_key")
    best = rows.where("root is not null").groupBy("root").agg(F.min(order).alias("best")).select("best.*")
    blank = rows.where("root is null").select("id", "text_key").distinct()
    kept = best.select("id", "text_key").unionByName(blank)
    kept = materialized(kept.select(F.col("id").alias("_id"), F.col("text_key").alias("_key")), "kept")
    df = boxed(docs)
    key = F.md5(F.coalesce(F.col("_row.text"), F.lit("")))
    df = df.join(kept, F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (key == F.col("_key")), "left_semi")
    shown = rows.where("root is not null")
    if not shown.groupBy("id", "text_key").count().where("count > 1").isEmpty():
        keyed = df.withColumns({"_id": F.col("_row.doc_id"), "_key": key})
        inked = F.coalesce(F.col("_row.text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
        df = keyed.where(inked).dropDuplicates(["_id", "_key"]).unionByName(keyed.where(~inked))
    return df.select(*unboxed(df, docs.columns))

"""Removing passages that repeat across documents, with suffix arrays over what they share.

A byte is removed if a string of ``length`` bytes that covers it also starts in an earlier document
(smaller doc_id), judged on the input.

1. The strings of ``length`` bytes that start in a document are dealt into blocks: all strings in a row
   whose least-hashed k-gram (the anchor) is the same one. Equal strings have equal anchors, so they lie
   in blocks with equal anchors. Only hashes of anchors and blocks are shuffled, by anchor.
2. If all blocks of an anchor are the same one (40 bits of the anchor and 64 of the block agree), it is
   removed from all documents but the earliest. Where an anchor has several different blocks, strings may
   be shared in part: these blocks' bytes are gathered by anchor (a bit map of such anchors lets a second
   pass over the texts send little else), a suffix array over the blocks of an anchor puts equal strings
   side by side, and each run of equal strings belongs to its earliest document. An anchor with more than
   ``HOT`` blocks is dealt over salts with a suffix array each; strings of a salt's earliest document are
   then compared over the salts, by their bytes.
3. Removed spans go back to their documents.

The suffix array (``suffixes``) groups suffixes by Lyndon prefixes; an anchor is one symbol there. A
block that occurs several times is sent once per batch of texts, so frequent lines stay small.

Null text is empty. Documents shorter than ``length`` lose nothing. Copies of an earlier document are
removed whole. Null ids come last. Rows that share an id, or have none, take nothing from one another,
whether their texts agree or not: only a smaller id counts. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewatch.llm import textarrays as ta
from vanewatch.llm.frames import in_pieces
from vanewatch.llm.mixing import ranked
from vanewatch.llm.suffixes import suffix_array
from vanewatch.session import materialized

#: Bytes of a text that are turned into arrays at once.
SEGMENT = 1 << 22
#: Text bytes per shuffle partition of the anchors.
PARTITION = 8 << 20
#: Bits of the anchor map per anchor, and at most.
BITS_EACH, MOST_BITS = 32, 1 << 30
#: Blocks of an anchor that one task gathers; the blocks of an anchor with more are dealt over salts. Where
#: more anchors than MOST_HOT have as many, a task gathers more, so that the list that tasks get stays bounded.
HOT, MOST_HOT = 4096, 1 << 20
_SPAN = 1 << 16
_WHOLE = -1


def anchor_size(length: int) -> int:
    return max(1, length * 12 // 25)


def segments(uids: list[int], texts: list[str], length: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts as bytes, long ones cut with an overlap; with the document and the place of each segment."""
    parts, owner, base = [], [], []
    for uid, text in zip(uids, texts, strict=True):
        data = text.encode()
        for at in range(0, max(len(data) - length + 1, 0), SEGMENT):
            parts.append(data[at : at + SEGMENT + length - 1])
            owner.append(uid)
            base.append(at)
    return parts, np.array(owner, np.int64), np.array(base, np.int64)


class Blocks:
    """The blocks of a batch: where they start and end, their anchors, contents and documents.

    Documents whose uids agree but for their last ``bits`` bits have one id.
    """

    def __init__(self, uids: list[int], texts: list[str], length: int, bits: int = 0):
        self.bits = bits
        parts, owner, base = segments(uids, texts, length)
        k = anchor_size(length)
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        sizes = np.array([len(p) for p in parts], np.int64)
        starts = np.cumsum(sizes) - sizes
        n = len(self.data) - length + 1
        if n <= 0:
            nothing = np.zeros(0, np.int64)
            self.first = self.end = self.at = self.uid = self.start = nothing
            self.anchor = self.content = nothing.astype(np.uint64)
            return
        sums = ta.prefix_sums(self.data)
        grams = np.arange(len(self.data) - k + 1)
        hashes = ta.run_hashes(sums, grams, grams + k)
        low = np.uint64(0xFFFFFFFF)
        least = (hashes & ~low) | grams.astype(np.uint64)
        width, reach = length - k + 1, 1
        while reach * 2 <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
        at = (least & low).astype(np.int64)
        part = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)
        inside = np.flatnonzero(part[:n] == part[length - 1 :])
        fresh = np.ones(len(inside), bool)
        fresh[1:] = (at[inside[1:]] != at[inside[:-1]]) | (part[inside[1:]] != part[inside[:-1]])
        cuts = np.flatnonzero(fresh)
        self.first = inside[cuts]
        self.end = inside[np.append(cuts[1:], len(inside)) - 1] + length
        self.at = at[self.first]
        self.anchor = hashes[self.at] >> np.uint64(24)
        self.content = ta.run_hashes(sums, self.first, self.end)
        of = part[self.first]
        self.uid, self.start = owner[of], base[of] + self.first - starts[of]

    def earliest(self) -> np.ndarray:
        """Which blocks belong to the earliest of the batch's documents that has them."""
        order = np.argsort(self.content, kind="stable")
        fresh = np.zeros(len(order), bool)
        fresh[:1] = True
        for hashes in (self.content[order], self.anchor[order]):
            fresh[1:] |= hashes[1:] != hashes[:-1]
        cuts = np.flatnonzero(fresh)
        least = np.minimum.reduceat(self.uid[order], cuts) if len(cuts) else self.uid
        mine = np.empty(len(order), bool)
        mine[order] = self.uid[order] >> self.bits == np.repeat(least, np.diff(np.append(cuts, len(order)))) >> self.bits
        return mine

    def spans(self, rows: np.ndarray) -> np.ndarray:
        return self.start[rows] * _SPAN + (self.end - self.first)[rows]


#: Spans of documents; with an anchor, span is the number of its blocks.
FOUND = "uid long, span long, anchor long"
#: Spans of documents; with a string, they are gone only if an earlier document has the string.
DECIDED = "uid long, span long, string binary"


def _found(uid: np.ndarray, span: np.ndarray, anchors: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([pa.array(uid, pa.int64()), pa.nulls(len(anchors), pa.int64())]),
            pa.concat_arrays([pa.array(span, pa.int64()), pa.array(n, pa.int64())]),
            pa.concat_arrays([pa.nulls(len(uid), pa.int64()), pa.array(anchors.astype(np.int64), pa.int64())]),
        ],
        ["uid", "span", "anchor"],
    )


def _unpacked(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(body, np.int64)
    return both[: len(both) // 2], both[len(both) // 2 :]


def _thinned(anchor: np.ndarray, content: np.ndarray, uid: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows by anchor; two of an anchor with several blocks, which the bytes decide.

    They have the least and the greatest uid, different contents, size 0 and for start the blocks they stand for.
    """
    order = np.argsort(anchor, kind="stable")
    anchor, content, uid, span = anchor[order], content[order], uid[order], span[order]
    first = np.ones(len(anchor), bool)
    first[1:] = anchor[1:] != anchor[:-1]
    other = np.zeros(len(anchor), bool)
    other[1:] = ~first[1:] & (content[1:] != content[:-1])
    differs = np.flatnonzero(other)
    if not len(differs):
        return anchor, content, uid, span
    groups = np.flatnonzero(first)
    sizes = np.diff(np.append(groups, len(anchor)))
    several, at = np.unique((np.cumsum(first) - 1)[differs], return_index=True)
    one, two = groups[several], differs[at]
    least, greatest = np.minimum.reduceat(uid, groups)[several], np.maximum.reduceat(uid, groups)[several]
    uid[one], uid[two] = least, greatest
    span[one], span[two] = (sizes[several] - 1) * _SPAN, _SPAN
    alone = np.ones(len(groups), bool)
    alone[several] = False
    keep = np.repeat(alone, sizes)
    keep[one] = keep[two] = True
    return anchor[keep], content[keep], uid[keep], span[keep]


def _send_hashes(length: int, parts: int, id_bits: int):
    """Rows (slot, body): hashes of blocks by anchor; slot -1: spans that the batch itself decides."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in in_pieces(batches, "text"):
            blocks = Blocks(batch.column(0).to_pylist(), texts, length, id_bits)
            mine = blocks.earliest()
            own, rest = np.flatnonzero(mine), np.flatnonzero(~mine)
            rows = _thinned(blocks.anchor[own], blocks.content[own], blocks.uid[own], blocks.spans(own))
            slot = (rows[0] % np.uint64(parts)).astype(np.int64)
            order = np.argsort(slot, kind="stable")
            slot = slot[order]
            anchor, content, uid, spans = (c[order] for c in rows)
            cuts = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(slot) else slot
            ends = np.append(cuts[1:], len(slot)) if len(slot) else slot
            columns = (
                (anchor & np.uint64(0xFFFFFFFF)).astype(np.uint32),
                (anchor >> np.uint64(32)).astype(np.uint8),
                content,
                uid,
                (spans // _SPAN).astype(np.uint32),
                (spans % _SPAN).astype(np.uint16),
            )
            bodies, slots = [], []
            for a, b in zip(cuts, ends, strict=True):
                bodies.append(b"".join(c[a:b].tobytes() for c in columns))
                slots.append(int(slot[a]))
            if len(rest):
                bodies.append(blocks.uid[rest].tobytes() + blocks.spans(rest).tobytes())
                slots.append(-1)
            yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(bodies, pa.binary())], ["slot", "body"])

    return run


_KINDS = ((np.uint32, 4), (np.uint8, 1), (np.uint64, 8), (np.int64, 8), (np.uint32, 4), (np.uint16, 2))
_ROW = sum(size for _, size in _KINDS)


def _match_hashes(id_bits: int):
    """Spans of an anchor's only block in later documents; anchors with several blocks are left to their bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list[np.ndarray]] = [[] for _ in _KINDS]
        for batch in batches:
            for slot, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if slot < 0:
                    yield _found(*_unpacked(body), *[np.zeros(0, np.int64)] * 2)
                    continue
                n, at = len(body) // _ROW, 0
                for column, (kind, size) in zip(columns, _KINDS, strict=True):
                    column.append(np.frombuffer(body, kind, n, at))
                    at += n * size
        if not columns[0]:
            return
        low, high, content, uid, start, size = (np.concatenate(c) for c in columns)
        columns.clear()
        anchor = (high.astype(np.uint64) << np.uint64(32)) | low
        order = np.argsort(anchor, kind="stable")
        anchor, content, uid = anchor[order], content[order], uid[order]
        first = np.ones(len(anchor), bool)
        first[1:] = anchor[1:] != anchor[:-1]
        groups = np.flatnonzero(first)
        other = np.zeros(len(anchor), bool)
        other[1:] = ~first[1:] & (content[1:] != content[:-1])
        several = np.add.reduceat(other, groups) > 0
        least, sizes = np.minimum.reduceat(uid, groups), np.diff(np.append(groups, len(uid)))
        later = np.flatnonzero((uid >> id_bits > np.repeat(least, sizes) >> id_bits) & ~np.repeat(several, sizes))
        span = start.astype(np.int64) * _SPAN + size
        several &= least >> id_bits < np.maximum.reduceat(uid, groups) >> id_bits
        n = np.add.reduceat(np.where(size == 0, start, 1).astype(np.int64)[order], groups)
        yield _found(uid[later], span[order[later]], anchor[groups[several]], n[several])

    return run


def anchor_map(anchors: DataFrame, bits: int) -> np.ndarray:
    """A bit for each anchor's remainder; a table of ``bits`` bits."""
    place = F.pmod("anchor", F.lit(bits)) + 1
    rows = anchors.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    found = np.zeros(bits // 8, np.uint8)
    for row in rows.toLocalIterator():  # a few KB each, ``bits`` in all
        at = (row["bucket"] - 1) * 4096
        found[at : at + 4096] = np.frombuffer(row["bits"], np.uint8)[: len(found) - at]
    return found


def _send_blocks(length: int, parts: int, bits: int, id_bits: int, shared):
    """Rows (slot, anchor, salt, uid, start, before, content): blocks whose anchor is in the map.

    Blocks of hot anchors have salts from 1 on, others 0. Without an anchor: content holds spans that the
    batch itself decides.
    """
    names = ["slot", "anchor", "salt", "uid", "start", "before", "content"]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked, hot, salts = shared.value
        for batch, texts in in_pieces(batches, "text"):
            blocks = Blocks(batch.column(0).to_pylist(), texts, length, id_bits)
            place = (blocks.anchor % np.uint64(bits)).astype(np.int64)
            kept, mine = (marked[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool), blocks.earliest()
            wanted, rest = np.flatnonzero(kept & mine), np.flatnonzero(kept & ~mine)
            raw = blocks.data.tobytes()
            body = [raw[a:b] for a, b in zip(blocks.first[wanted].tolist(), blocks.end[wanted].tolist(), strict=True)]
            anchor, salt = blocks.anchor[wanted].astype(np.int64), np.zeros(len(wanted), np.int64)
            if len(hot):
                known = np.minimum(np.searchsorted(hot, anchor), len(hot) - 1)
                luck = ta.mix(ta.mix(blocks.uid[wanted]) + blocks.start[wanted].astype(np.uint64))
                salt = np.where(hot[known] == anchor, 1 + (luck % salts[known]).astype(np.int64), 0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(((anchor + salt) % parts).astype(np.int32)), pa.array(anchor),
                    pa.array(salt.astype(np.int32)), pa.array(blocks.uid[wanted]),
                    pa.array(blocks.start[wanted]), pa.array((blocks.at - blocks.first)[wanted].astype(np.int32)),
                    pa.array(body, pa.binary()),
                ],
                names,
            )
            if len(rest):
                # batches may be cut otherwise than in the first pass, so what they decide is sent again
                row = [int(blocks.uid[rest[0]] % parts), None, None, None, None, None, blocks.uid[rest].tobytes() + blocks.spans(rest).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names)

    return run


def equal_strings(contents: list[tuple[bytes, int]], length: int, least: int = 2) -> Iterator[tuple[bytes, list[tuple[int, int]]]]:
    """Strings at ``least`` places or more of contents (bytes, place of the anchor), with (content, start)."""
    k, m = anchor_size(length), len(contents)
    text: list[int] = []
    who: list[int] = []
    at: list[int] = []
    for i, (content, before) in enumerate(contents):
        text.extend([c + m for c in content[:before]])
        text.append(m + 256)
        text.extend([c + m for c in content[before + k :]])
        text.append(m - 1 - i)
        n = len(content) - length + 1
        who.extend([i] * n + [-1] * (len(text) - len(who) - n))
        at.extend(range(len(text) - len(at)))
    run: list[int] = []
    last = b""
    for p in suffix_array(text):
        i = who[p]
        if i < 0:
            continue
        string = contents[i][0][at[p] : at[p] + length]
        if string == last:
            run.append(p)
            continue
        if run and len(run) >= least:
            yield last, [(who[q], at[q]) for q in run]
        run, last = [p], string
    if run and len(run) >= least:
        yield last, [(who[q], at[q]) for q in run]


def _match_blocks(length: int, id_bits: int):
    k = anchor_size(length)
    half = (length - k) // 2

    def alike(contents: Iterable[tuple[bytes, int]]) -> list[tuple[bytes, int]]:
        """Contents that may share a string: it holds the anchor and half of what is left on one of its sides."""
        sides: dict[tuple[int, bytes], int] = {}
        keys = []
        for content, before in contents:
            left = (0, content[before - half : before + k]) if before >= half else None
            right = (1, content[before : before + k + half]) if len(content) - before - k >= half else None
            keys.append((left, right))
            for side in (left, right):
                if side:
                    sides[side] = sides.get(side, 0) + 1
        return [c for c, pair in zip(contents, keys, strict=True) if any(s and sides[s] > 1 for s in pair)]

    def solve(rows: list[tuple[int, int, int, bytes]], salted: bool) -> Iterator[tuple[int, int, bytes | None]]:
        """From (uid, start, before, content) of one anchor: (uid, span, string).

        ``salted``: other tasks have blocks of the anchor too; strings of the earliest document here are left open.
        """
        least: dict[tuple[bytes, int], int] = {}
        for uid, _, before, content in rows:
            key = content, before
            if least.get(key, uid) >= uid:
                least[key] = uid
        begins: dict[tuple[bytes, int], list[int]] = {}
        open_: dict[tuple[bytes, int], list[tuple[int, bytes]]] = {}
        like = list(least) if salted else alike(least) if len(least) > 1 else []
        owner = [least[c] for c in like]
        if salted or len({o >> id_bits for o in owner}) > 1:
            for string, places in equal_strings(like, length, 1 if salted else 2):
                first = min(owner[i] for i, _ in places) >> id_bits
                for i, at in places:
                    if owner[i] >> id_bits > first:
                        begins.setdefault(like[i], []).append(at)
                    elif salted:
                        open_.setdefault(like[i], []).append((at, string))
        spans: dict[tuple[bytes, int], list[int]] = {}
        for c, found in begins.items():
            merged: list[int] = []
            for s in sorted(found):
                if merged and s <= merged[-1] // _SPAN + merged[-1] % _SPAN:
                    begin = merged[-1] // _SPAN
                    merged[-1] = begin * _SPAN + s + length - begin
                else:
                    merged.append(s * _SPAN + length)
            spans[c] = merged
        for uid, start, before, content in rows:
            if uid >> id_bits > least[content, before] >> id_bits:
                yield uid, start * _SPAN + len(content), None
                continue
            for span in spans.get((content, before), ()):
                yield uid, start * _SPAN + span, None
            for at, string in open_.get((content, before), ()):
                yield uid, (start + at) * _SPAN + length, string

    def decided(found: Iterable[tuple[int, int, bytes | None]]) -> pa.RecordBatch:
        uid, span, string = zip(*found, strict=True) if found else ((), (), ())
        columns = [pa.array(uid, pa.int64()), pa.array(span, pa.int64()), pa.array(string, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["uid", "span", "string"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, found = (None, 0), [], []
        for batch in batches:
            for anchor, salt, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if anchor is None:
                    uid, span = _unpacked(row[-1])
                    columns = [pa.array(uid), pa.array(span), pa.nulls(len(uid), pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["uid", "span", "string"])
                    continue
                if (anchor, salt) != group:
                    if len(rows) > 1 or (rows and group[1]):
                        found.extend(solve(rows, group[1] > 0))
                    group, rows = (anchor, salt), []
                rows.append(row)
            yield decided(found)
            found = []
        if len(rows) > 1 or (rows and group[1]):
            yield decided(list(solve(rows, group[1] > 0)))

    return run


def _numbered(docs: DataFrame, id_column: str) -> tuple[DataFrame, int]:
    """Rows (uid, id, text), and how many last bits of uid tell texts of one id apart.

    uid is the id itself if ids are whole numbers without repeats, else the rank of the id, and of the text
    among those of the id.
    """
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    rows = docs.select(F.col(id_column).alias("id"), text)
    ids = rows.groupBy("id").count().where("count > 1 or id is null")
    if dict(rows.dtypes)["id"] in ("bigint", "int") and ids.isEmpty():
        return rows.select(F.col("id").cast("bigint").alias("uid"), "id", "text"), 0
    keyed = rows.withColumn("key", F.md5("text"))
    texts = ranked(keyed.select("id", "key").distinct(), F.col("id").asc_nulls_last(), "key")
    texts = materialized(texts.select("id", "key", "rank"), "texts")
    first = materialized(texts.groupBy("id").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")), "first-texts")
    bits = int((first.agg(F.max("n")).first()[0] or 1) - 1).bit_length()
    numbers = ranked(first, F.col("first")).select(F.col("id").alias("_of"), "first", F.col("rank").alias("number"))
    numbers = materialized(numbers, "ids")
    order = texts.join(numbers, texts["id"].eqNullSafe(numbers["_of"]))
    uid = F.shiftleft("number", bits) + F.col("rank") - F.col("first")
    order = materialized(order.select(F.col("id").alias("_id"), F.col("key").alias("_key"), uid.alias("uid")), "order")
    same = keyed["id"].eqNullSafe(order["_id"]) & (keyed["key"] == order["_key"])
    return materialized(keyed.join(order, same).select("uid", "id", "text"), "numbered"), bits


def _remove(length: int, keep_text: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in in_pieces(batches, "text"):
            rows = []
            for text, spans in zip(texts, batch.column(2).to_pylist(), strict=True):
                data = np.frombuffer(text.encode(), np.uint8)
                edge = np.zeros(len(data) + 1, np.int32)
                if spans and len(data) >= length:
                    if _WHOLE in spans:
                        spans = [(0, len(data))]
                    else:
                        spans = [(s // _SPAN, s // _SPAN + s % _SPAN) for s in spans]
                    np.add.at(edge, [a for a, _ in spans], 1)
                    np.add.at(edge, [b for _, b in spans], -1)
                gone = np.cumsum(edge[:-1]) > 0
                change = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                kept = data[~gone].tobytes()
                sums = hashlib.sha256(kept).hexdigest()
                cut = [{"start": a, "end": b} for a, b in zip(change[::2].tolist(), change[1::2].tolist(), strict=True)]
                rows.append((len(data), int(gone.sum()), len(cut), sums, cut, kept))
            n_bytes, n_removed, n_spans, sha, cuts, kept = zip(*rows, strict=True)
            columns = [
                batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                pa.array(n_spans, pa.int64()), pa.array(sha, pa.string()),
                pa.array(cuts, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ]
            if keep_text:
                columns.append(pa.array(kept, pa.binary()))
            names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
            yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    return run


def without_repeats(
    docs: DataFrame, length: int = 50, id_column: str = "doc_id", keep_text: bool = False
) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256, spans and, if wanted, kept bytes."""
    spark = docs.sparkSession
    rows, id_bits = _numbered(docs, id_column)

    def earlier(first: str) -> Column:
        """Does ``uid`` have a greater id than the document in the other column?"""
        return F.shiftright("uid", id_bits) > F.shiftright(first, id_bits)

    sizes = rows.select("uid", F.md5("text").alias("key"), F.octet_length("text").alias("size"))
    sizes = materialized(sizes, "sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    parts = max(8, -(-total // PARTITION))
    texts = rows.select("uid", "text")
    sent = texts.mapInArrow(_send_hashes(length, parts, id_bits), "slot int, body binary")
    dealt = sent.repartition(parts, F.when(F.col("slot") < 0, -1 - F.pmod(F.xxhash64("body"), F.lit(parts))).otherwise(F.col("slot")))
    found = materialized(dealt.mapInArrow(_match_hashes(id_bits), FOUND), "found")
    spans = found.where("uid is not null").select("uid", "span")
    anchors = found.where("anchor is not null").select("anchor", F.col("span").alias("n"))
    n = anchors.count()
    if n:
        bits = min(MOST_BITS, 1 << max(20, (BITS_EACH * n - 1).bit_length()))
        most = HOT
        while anchors.where(F.col("n") > most).count() > MOST_HOT:
            most *= 2
        many = sorted((r["anchor"], r["n"]) for r in anchors.where(F.col("n") > most).collect())  # MOST_HOT rows
        hot, salts = (np.array([r[i] for r in many], np.int64) for i in (0, 1))
        shared = spark.sparkContext.broadcast((anchor_map(anchors, bits), hot, (2 * salts // most + 1).astype(np.uint64)))
        schema = "slot int, anchor long, salt int, uid long, start long, before int, content binary"
        blocks = texts.mapInArrow(_send_blocks(length, parts, bits, id_bits, shared), schema)
        blocks = blocks.repartition(parts, "slot").sortWithinPartitions("anchor", "salt").drop("slot")
        more = materialized(blocks.mapInArrow(_match_blocks(length, id_bits), DECIDED), "found")
        spans = spans.unionByName(more.where("string is null").select("uid", "span"))
        if many:
            places = more.where("string is not null")
            earliest = places.groupBy("string").agg(F.min("uid").alias("first"), F.max("uid").alias("last"))
            # stored like the places, so that Spark can split the rows of a hot string
            earliest = materialized(earliest.where("first < last"), "strings")
            spans = spans.unionByName(places.join(earliest, "string").where(earlier("first")).select("uid", "span"))
    first = sizes.groupBy("key").agg(F.min("uid").alias("first"), F.max("uid").alias("last")).where("first < last")
    # stored, so that both sides of the join are plain shuffles, of which Spark can split hot parts
    first = materialized(first, "first")
    copies = sizes.join(first, "key").where(earlier("first")).select("uid", F.lit(_WHOLE).cast("bigint").alias("span"))
    gone = spans.unionByName(copies).groupBy("uid").agg(F.collect_list("span").alias("gone"))
    gone = gone.withColumnRenamed("uid", "_uid")
    joined = rows.join(gone, F.col("uid") == F.col("_uid"), "left").select("id", "text", "gone")
    schema = f"id {dict(rows.dtypes)['id']}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>"
    result = joined.mapInArrow(_remove(length, keep_text), schema + ", kept binary" * keep_text)
    return result.withColumnRenamed("id", id_column)

"""Token counts by rank-synchronous merging of ragged arrays.

The texts of a batch are cut into pre-tokens as the vocabulary file says; distinct pre-tokens not seen
before are held as one ragged numpy array of symbols. In each round every sequence merges its
lowest-rank pair (all occurrences, from the left), for all sequences at once, until none has a pair of
the merge table; the symbols that survive are the tokens. Counts are kept by pre-token hash, up to a
bound, for later batches of the same worker process.

Reads byte-level BPE files whose pre-tokenizer is the contraction, letters, single-number, other
pattern, over text in NFC and lower case, with a word-end suffix. Special strings inside a text are one
token each, as is the library's default. Null counts as empty text with 0 tokens; long texts are cut at
no place but their own pre-tokens; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewatch.llm import textarrays as ta
from vanewatch.llm.alphabet import Alphabet, alphabet
from vanewatch.llm.frames import in_pieces

#: Pre-tokens whose count a worker remembers.
REMEMBERED = 1_500_000
_NONE = np.int64(1 << 40)
#: The contractions of the vocabulary's pre-tokenizer, after the apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def byte_names() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the rest from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def pretokens(points: np.ndarray, starts: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of folded texts, in order; ``kind`` has the class of each code point."""
    if not len(kind):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = ta.runs(kind, starts)
    cuts = np.zeros(len(kind) + 1, bool)
    cuts[first] = True
    cuts[:-1] |= kind == ta.NUMBER
    cuts[1:] |= kind == ta.NUMBER
    # an apostrophe alone before letters joins them if they begin like a contraction
    lone = first[(last - first == 1) & (points[first] == ord("'"))]
    letters = np.zeros(len(kind) + 1, bool)
    letters[first] = kind[first] == ta.LETTER
    letters[starts] = False
    lone = lone[letters[lone + 1]]
    if len(lone):
        ends = last[np.searchsorted(first, lone + 1)]
        open_ = np.ones(len(lone), bool)
        for tail in CONTRACTIONS:
            fits = open_ & (ends - lone - 1 >= len(tail))
            for i, c in enumerate(tail):
                fits[fits] = points[lone[fits] + 1 + i] == ord(c)
            at = lone[fits]
            cuts[at + 1] = False
            cuts[at + 1 + len(tail)] = True
            open_ &= ~fits
    cuts[-1] = True
    edges = np.flatnonzero(cuts)
    begin, end = edges[:-1], edges[1:]
    words = kind[begin] != ta.SPACE
    return begin[words], end[words]


class Merges:
    """A vocabulary file's symbols and merge table."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"] or ""
        names = byte_names()
        self.inner = np.array([vocab[c] for c in names], np.int64)
        self.final = np.array([vocab[c + suffix] for c in names], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        key = np.array([(vocab[a] << 20) | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.rank = key[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = re.compile("|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) or r"(?!)")

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 20) | right
        place = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[place] == key, self.rank[place], _NONE)

    def counts(self, data: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Surviving symbols of each sequence of bytes; no sequence is empty."""
        result = length.astype(np.int64)
        symbol = self.inner[data]
        ends = np.cumsum(length)
        symbol[ends - 1] = self.final[data[ends - 1]]
        alive = np.arange(len(length))
        while len(alive):
            ends = np.cumsum(length)
            pair = np.full(len(symbol), _NONE)
            pair[:-1] = self.ranks(symbol[:-1], symbol[1:])
            pair[ends - 1] = _NONE
            least = np.minimum.reduceat(pair, ends - length)
            hit = np.flatnonzero((pair == np.repeat(least, length)) & (pair < _NONE))
            # of overlapping pairs every second one, from the left
            fresh = np.ones(len(hit), bool)
            fresh[1:] = np.diff(hit) > 1
            place = np.arange(len(hit))
            since = place - np.maximum.accumulate(np.where(fresh, place, 0))
            hit = hit[since % 2 == 0]
            symbol[hit] = self.merged[pair[hit]]
            keep = np.ones(len(symbol), bool)
            keep[hit + 1] = False
            gone = np.bincount(np.searchsorted(ends, hit, side="right"), minlength=len(length))
            length = length - gone
            result[alive] = length
            symbol = symbol[keep]
            going = (least < _NONE) & (length > 1)
            if not going.all():
                symbol = symbol[np.repeat(going, length)]
                length, alive = length[going], alive[going]
        return result


def merges(path: str) -> Merges:
    return ta.once(("merges", path), lambda: Merges(path))


class Memory:
    """Sorted hashes with a value each; forgets everything when it holds too many."""

    def __init__(self, most: int = REMEMBERED):
        self.most = most
        self.hashes, self.values = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of sorted distinct hashes, and which of them are unknown."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.ones(len(hashes), bool)
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.values[place], self.hashes[place] != hashes

    def add(self, hashes: np.ndarray, values: np.ndarray) -> None:
        if len(self.hashes) + len(hashes) > self.most:
            self.hashes, self.values = self.hashes[:0], self.values[:0]
        every, value = np.concatenate([self.hashes, hashes]), np.concatenate([self.values, values])
        order = np.argsort(every, kind="stable")
        self.hashes, self.values = every[order], value[order]


def token_counts(texts: list[str], table: Merges, letters: Alphabet, memory: Memory) -> np.ndarray:
    """Tokens of each text."""
    owner, parts, found = [], [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if "<" in text and table.split.search(text):
            found[i] += len(table.split.findall(text))
            for part in table.split.split(text):
                owner.append(i)
                parts.append(letters.folded(part))
        else:
            owner.append(i)
            parts.append(letters.folded(text))
    points, starts = ta.code_points(parts)
    begin, end = pretokens(points, starts, letters.kinds(points))
    if len(begin):
        hashes = ta.run_hashes(ta.prefix_sums(points), begin, end)
        distinct, example, which = np.unique(hashes, return_index=True, return_inverse=True)
        value, unknown = memory.find(distinct)
        if unknown.any():
            a, b = begin[example[unknown]], end[example[unknown]]
            some = points[ta.gathered(a, b - a)]
            wide = 1 + (some > 0x7F).astype(np.int64) + (some > 0x7FF) + (some > 0xFFFF)
            data = np.frombuffer(some.tobytes().decode("utf-32-le").encode(), np.uint8)
            value[unknown] = table.counts(data, np.add.reduceat(wide, np.cumsum(b - a) - (b - a)))
            memory.add(distinct[unknown], value[unknown])
        part = np.searchsorted(starts, begin, side="right") - 1
        found += np.bincount(np.array(owner)[part], value[which], len(texts)).astype(np.int64)
    return found


def counted_tokens(docs: DataFrame, path: str, limit: int = 2048, id_column: str = "doc_id") -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit."""
    kind = dict(docs.dtypes)[id_column]

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, letters, memory = merges(path), alphabet(path), ta.once(("counts", path), Memory)
        for batch, texts in in_pieces(batches, "text"):
            n_bytes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            n_tokens = pa.array(token_counts(texts, table, letters, memory), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, n_tokens], ["id", "n_bytes", "n_tokens"])

    thin = docs.select(F.col(id_column).alias("id"), F.col("text").alias("text"))
    found = thin.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    return found.select(
        F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )

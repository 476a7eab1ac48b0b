"""Periodic runs of words: common extensions by a difference cover, runs on harmonic grids.

Words of a batch of texts stand in one array, each text closed by a symbol of its own, so that nothing
matches across texts. Suffixes are sorted only where their place, modulo V, lies in a difference cover D:
for any two places some shift below V puts both on the cover. The longest common extension of two places
compares at most V - 1 words one by one until both are on the cover, and takes the rest from the sorted
samples: the least of the neighbouring common prefixes between them, by a sparse table.

For each period q the grid 0, q, 2q, ... has two neighbouring points in every run of length 3q or more, so
n/q extensions find all runs of period q, and n log n all runs of a text. The first grid point of a run
gives its end; its start follows by bisection. Of equal stretches the smallest period stays.

A run is a stretch of words with smallest period q and a length of at least ``min_length`` and
``min_repeats`` * q (three or more) that no neighbouring word extends. Words are ``[^\\x20\\x09-\\x0D]+``.
Null, empty and short texts have no runs. Repeated rows are handled one by one, ids may be null and are
only handed on. Long texts are arrays of one task, about 60 bytes a word; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewatch.llm import textarrays as ta
from vanewatch.llm.frames import in_pieces

#: A perfect difference set: every residue but 0 is the difference of exactly one pair.
V, COVER = 31, (1, 5, 11, 24, 25, 27)
#: Grid points looked at together.
POINTS = 1 << 20
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def dense_ranks(keys: list[np.ndarray]) -> np.ndarray:
    """Rank of each row by its keys, the first key first; equal rows share a rank."""
    order = np.lexsort(keys[::-1])
    step = np.zeros(len(order), np.int64)
    for key in keys:
        step[1:] |= key[order[1:]] != key[order[:-1]]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(step)
    return ranks


class Extensions:
    """Longest common extensions of any two places of ``words``.

    Any two suffixes must differ before the array ends (a last symbol that occurs once does that).
    """

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        blocks = self.n // V + 1
        self.words = np.zeros((blocks + 1) * V, np.int64)
        self.words[: self.n] = words + 1
        cover = np.array(COVER)
        self.inside = np.full(V, -1)
        self.inside[cover] = np.arange(len(cover))
        #: by (j - i) mod V: the residue of i that puts both on the cover
        self.meet = np.zeros(V, np.int64)
        self.meet[0] = cover[0]
        for a in COVER:
            for b in COVER:
                if a != b:
                    self.meet[(b - a) % V] = a
        places = (np.arange(blocks)[:, None] * V + cover).ravel()
        places = places[places < self.n]
        self._sort(places)

    def _sort(self, places: np.ndarray) -> None:
        n = len(places)
        # windows of V words, several words to a key, then doubling: place + V is a sample too
        bits = max(int(self.words.max(initial=1)).bit_length(), 1)
        each = max(63 // bits, 1)
        keys = []
        for at in range(0, V, each):
            key = np.zeros(n, np.int64)
            for k in range(at, min(at + each, V)):
                key = (key << bits) | self.words[places + k]
            keys.append(key)
        rank = dense_ranks(keys)
        levels, width = [rank], 1  # level k ranks windows of V * 2^k words
        while n and rank.max() < n - 1:
            ahead = np.full(n, -1, np.int64)
            step = width * len(COVER)
            ahead[: max(n - step, 0)] = rank[step:]
            rank = dense_ranks([rank * (n + 1) + ahead + 1])
            levels.append(rank)
            width *= 2
        self.rank = rank
        order = np.argsort(rank)
        self.places = places
        left, right = order[:-1], order[1:]
        shared = np.zeros(len(left), np.int64)  # samples ahead
        for k in range(len(levels) - 1, -1, -1):
            step = shared * len(COVER)
            a, b = left + step, right + step
            fits = (a < n) & (b < n)
            same = np.zeros(len(left), bool)
            same[fits] = levels[k][a[fits]] == levels[k][b[fits]]
            shared += same * (1 << k)
        a, b = places[left] + shared * V, places[right] + shared * V
        least = shared * V + self._compare(a, b, np.full(len(a), V))
        self.table = [least.astype(np.int32)]
        while len(self.table[-1]) > 1 << (len(self.table) - 1):
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))

    def _compare(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from both places on, up to ``most``."""
        same = most.copy()
        open_ = np.flatnonzero(most > 0)
        for k in range(int(most.max(initial=0))):
            equal = self.words[i[open_] + k] == self.words[j[open_] + k]
            same[open_[~equal]] = k
            open_ = open_[equal]
            open_ = open_[most[open_] > k + 1]
            if not len(open_):
                break
        return same

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For pairs of different places."""
        shift = (self.meet[(j - i) % V] - i) % V
        same = self._compare(i, j, shift)
        far = np.flatnonzero(same == shift)
        if len(far):
            a, b = self._rank_of(i[far] + shift[far]), self._rank_of(j[far] + shift[far])
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp((high - low).astype(float))[1] - 1
            extra = np.zeros(len(far), np.int64)
            for k in np.unique(level):
                at = np.flatnonzero(level == k)
                row = self.table[k]
                extra[at] = np.minimum(row[low[at]], row[high[at] - (1 << k)])
            same[far] += extra
        return same

    def _rank_of(self, place: np.ndarray) -> np.ndarray:
        return self.rank[place // V * len(COVER) + self.inside[place % V]]


def runs(
    words: np.ndarray, starts: np.ndarray, min_length: int = 24, min_repeats: int = 3
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and periods of all runs, in order; ``starts`` has the first place of each text and the end.

    Each text's last word must be a symbol of its own.
    """
    if min_repeats < 3:
        raise ValueError("runs with fewer than three repeats need not show on the grid")
    length = np.diff(starts) - 1
    periods = np.maximum(length // min_repeats, 0)
    periods[length < min_length] = 0
    text = np.repeat(np.arange(len(length)), periods)
    none = np.zeros(0, np.int64)
    if not len(text):
        return none, none, none
    q = ta.gathered(np.ones(len(length), np.int64), periods)
    base, points = starts[text], length[text] // q - 1
    extend = Extensions(words)
    found = []
    ends = np.cumsum(points)
    at = 0
    while at < len(q):
        until = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + POINTS, side="right")), at + 1)
        found.append(_on_grids(words, extend, base[at:until], q[at:until], points[at:until]))
        at = until
    s, e, q = (np.concatenate(x) for x in zip(*found, strict=True))
    long = e - s >= np.maximum(min_length, min_repeats * q)
    s, e, q = s[long], e[long], q[long]
    order = np.lexsort([q, e, s])
    s, e, q = s[order], e[order], q[order]
    first = np.ones(len(s), bool)
    first[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    s, e, q = s[first], e[first], q[first]
    order = np.lexsort([q, s])
    return s[order], e[order], q[order]


def _on_grids(words, extend, base, q, points):
    """Stretches of period q around the first grid point of each that has its next q words twice."""
    grid = np.repeat(np.arange(len(q)), points)
    step = q[grid]
    i = base[grid] + ta.gathered(np.zeros(len(q), np.int64), points) * step
    for quarters in (0, 4, 2):  # words that must agree at any such point, and are cheap to compare
        at = i + (step - 1) * quarters // 4
        keep = np.flatnonzero(words[at] == words[at + step])
        i, step, grid = i[keep], step[keep], grid[keep]
    same = extend(i, i + step) if len(i) else i
    keep = same >= step
    i, step, grid, same = i[keep], step[keep], grid[keep], same[keep]
    first = np.ones(len(i), bool)
    first[1:] = (grid[1:] != grid[:-1]) | (i[1:] - i[:-1] != step[1:])
    i, step, grid, same = i[first], step[first], grid[first], same[first]
    end = i + step + same
    low, high = np.maximum(i - step + 1, base[grid]), i.copy()
    while True:  # from the start on all words up to i equal those a period later
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            break
        middle = (low[open_] + high[open_]) // 2
        reaches = middle + extend(middle, middle + step[open_]) >= i[open_]
        high[open_[reaches]] = middle[reaches]
        low[open_[~reaches]] = middle[~reaches] + 1
    return low, end, step


def split_words(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All words; their symbols, each text closed by one of its own; where the texts start."""
    # bytes.split() cuts at the six ASCII spaces and nothing else
    lists = [t.encode().split() for t in texts]
    every = [w for words in lists for w in words]
    codes = pd.factorize(np.array(every, object))[0].astype(np.int64) if every else np.zeros(0, np.int64)
    length = np.array([len(x) for x in lists], np.int64)
    starts = np.concatenate([[0], np.cumsum(length + 1)])
    symbols = np.zeros(starts[-1], np.int64)
    closing = starts[1:] - 1
    inside = np.ones(len(symbols), bool)
    inside[closing] = False
    symbols[inside] = codes
    symbols[closing] = (codes.max(initial=-1) + 1) + np.arange(len(texts))
    return every, symbols, starts


def _batch(texts: list[str], min_length: int, min_repeats: int) -> tuple[list[int], pa.Array, list[str | None]]:
    every, symbols, starts = split_words(texts)
    s, e, q = runs(symbols, starts, min_length, min_repeats)
    owner = np.searchsorted(starts, s, side="right") - 1
    offsets = np.searchsorted(owner, np.arange(len(texts) + 1))
    values = pa.StructArray.from_arrays(
        [pa.array(s - starts[owner]), pa.array(e - s), pa.array(q)], ["start", "length", "period"]
    )
    covered = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(covered, s + q, 1)
    np.add.at(covered, e, -1)
    kept = np.cumsum(covered)[:-1] == 0
    collapsed: list[str | None] = []
    for i in range(len(texts)):
        first, n = starts[i] - i, starts[i + 1] - starts[i] - 1
        words = every[first : first + n]
        if offsets[i + 1] > offsets[i]:
            words = [w for w, k in zip(words, kept[starts[i] : starts[i + 1] - 1], strict=True) if k]
        collapsed.append(b" ".join(words).decode())
    n_words = (np.diff(starts) - 1).tolist()
    return n_words, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values), collapsed


def periodic_runs(docs: DataFrame, min_length: int = 24, min_repeats: int = 3, id_column: str = "doc_id") -> DataFrame:
    """Per document: id, n_words, runs (start, length, period in words, by start and period), collapsed.

    ``collapsed`` has the words joined by one space, without those that repeat in a run (all but its first
    period).
    """
    kind = dict(docs.dtypes)[id_column]

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in in_pieces(batches, "text"):
            n_words, spans, collapsed = _batch(texts, min_length, min_repeats)
            columns = [batch.column(0), pa.array(n_words, pa.int64()), spans, pa.array(collapsed, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "runs", "collapsed"])

    thin = docs.select(F.col(id_column).alias("id"), F.col("text").alias("text"))
    found = thin.mapInArrow(find, f"id {kind}, n_words long, runs {RUNS}, collapsed string")
    return found.withColumnRenamed("id", id_column)

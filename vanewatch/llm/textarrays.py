"""Batches of texts as numpy arrays: code points, character classes, tokens and their hashes.

A hash of a run of code points is a sum of random values times powers of an odd number, modulo 2^64;
running sums give the hash of every run at once.
"""

from __future__ import annotations

import sys
import types
import unicodedata
from collections.abc import Callable, Hashable
from typing import Any

import numpy as np

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_BREAKS = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def once(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once in a worker process; tasks get functions anew, but find this again."""
    kept = sys.modules.setdefault("vanewatch_worker", types.ModuleType("vanewatch_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    category = unicodedata.category
    table = np.fromiter((kinds.get(category(chr(i))[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000)
    table[list(_BREAKS)] = SPACE
    return table


def classes() -> np.ndarray:
    """The class of every code point, by Unicode category."""
    return once("classes", _classes)


def _values() -> np.ndarray:
    """A random 64-bit value for every code point."""
    return once("values", lambda: mix(np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(_P)))


def powers(n: int) -> list[np.ndarray]:
    """The first n powers of the odd number and of its inverse; kept for the next call."""
    rows = once("powers", lambda: [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    if len(rows[0]) < n:
        for i, base in enumerate((_P, _P_INVERSE)):
            row = np.full(max(n, 1 << 20), base, np.uint64)
            row[0] = 1
            rows[i] = np.multiply.accumulate(row)
    return [row[:n] for row in rows]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points in a row, and where each text starts (with the end as last)."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), starts


def prefix_sums(points: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(_values()[points] * powers(len(points))[0], out=sums[1:])
    return sums


def run_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Scrambled hashes of the runs [start, end)."""
    return mix((sums[end] - sums[start]) * powers(len(sums))[1][start])


def folded(text: str) -> str:
    """NFC and lower case, each character on its own."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


def gathered(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of each run, all in a row."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - length), length)


def runs(kind: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of equal class inside texts: their starts and ends."""
    edge = np.zeros(len(kind) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[starts] = True
    edge[0] = edge[-1] = True
    cuts = np.flatnonzero(edge)
    return cuts[:-1], cuts[1:]

"""Directly addressable codes: chunk levels with continuation bitmaps and rank directories.

A value is split into chunks, low bits first. Level 0 holds the first chunk of every value, and a bitmap
that says which values go on; level 1 holds the second chunks of those, and so on. The place of a value's
chunk in the next level is the number of set bits before it (a directory of counts per block plus a
popcount inside the block), so any value is read from a fixed number of places; nothing around it is
decoded. Chunk widths are chosen from the bit lengths of the values, for the fewest bits in all.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np

#: Bits of a bitmap per entry of its rank directory.
BLOCK = 512
#: Widest chunk that four bytes hold at any bit offset.
WIDEST = 25
_AT_ONCE = 1 << 16


def widths(values: np.ndarray) -> list[int]:
    """Chunk widths with the fewest bits: dynamic programming over the bit lengths that occur."""
    longest = max(int(values.max(initial=0)).bit_length(), 1)
    exponents = np.zeros(1023 + 33, np.int64)  # of the values as doubles: 1023 more than the place of the highest bit, 0 for 0
    for at in range(0, len(values), _AT_ONCE):
        exponent = values[at : at + _AT_ONCE].astype(np.float64).view(np.int64) >> 52
        exponents += np.bincount(exponent, minlength=len(exponents))
    longer = [len(values), *(int(exponents[1023 + b :].sum()) for b in range(1, longest + 1))]
    best: list[tuple[float, list[int]]] = [(0.0, [])]  # by bits still to be stored, from the top
    for left in range(1, longest + 1):
        done = longest - left
        options = []
        for w in range(1, min(left, WIDEST) + 1):
            cost, tail = best[left - w]
            bits = w + (1 + 32 / BLOCK if tail else 0)
            options.append((cost + longer[done] * bits, [w, *tail]))
        best.append(min(options))
    return best[longest][1]


def _spans(width: int) -> Iterator[tuple[int, int, int, int]]:
    """For eight values in ``width`` bytes: which value, its first byte, how many bytes, free bits behind it in 32."""
    for j in range(8):
        first, inside = divmod(j * width, 8)
        yield j, first, -(-(inside + width) // 8), 32 - inside - width


def packed_bits(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of the values in a row, high bit first, and three bytes for reads past the end."""
    parts = [np.zeros(0, np.uint8)]
    for at in range(0, len(values), _AT_ONCE):  # a multiple of 8 values fills whole bytes
        some = values[at : at + _AT_ONCE] & np.uint32((1 << width) - 1)
        eights = np.zeros((-(-len(some) // 8), 8), np.uint32)
        eights.ravel()[: len(some)] = some
        eights = np.ascontiguousarray(eights.T)
        lines = np.zeros((width, eights.shape[1]), np.uint8)  # a line has one byte of all the eights
        for j, first, n, behind in _spans(width):
            word = eights[j] << np.uint32(behind)
            for k in range(n):
                lines[first + k] |= (word >> np.uint32(24 - 8 * k)).astype(np.uint8)
        parts.append(lines.T.ravel()[: -(-len(some) * width // 8)])
    return np.concatenate([*parts, np.zeros(3, np.uint8)])


def unpacked_bits(data: np.ndarray, width: int, start: int, end: int) -> np.ndarray:
    """The values at the places from ``start`` to before ``end``."""
    low, high = start // 8, -(-end // 8)
    result = np.zeros((high - low) * 8, np.uint32)
    for at in range(low, high, _AT_ONCE // 8):
        until = min(at + _AT_ONCE // 8, high)
        some = data[at * width : until * width]
        if len(some) < (until - at) * width:
            some = np.append(some, np.zeros((until - at) * width - len(some), np.uint8))
        lines = np.ascontiguousarray(some.reshape(-1, width).T).astype(np.uint32)
        eights = np.zeros((8, until - at), np.uint32)
        for j, first, n, behind in _spans(width):
            for k in range(n):
                eights[j] |= lines[first + k] << np.uint32(24 - 8 * k)
            eights[j] = (eights[j] >> np.uint32(behind)) & np.uint32((1 << width) - 1)
        result[(at - low) * 8 : (until - low) * 8] = eights.T.ravel()
    return result[start - low * 8 : end - low * 8]


def read_bits(data: np.ndarray, width: int, place: np.ndarray) -> np.ndarray:
    bit = place * width
    byte = bit >> 3
    word = np.zeros(len(place), np.uint32)
    for k in range(4):
        word = (word << np.uint32(8)) | data[byte + k]
    return (word >> (32 - width - (bit & 7)).astype(np.uint32)) & np.uint32((1 << width) - 1)


def set_before(words: np.ndarray, directory: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Set bits before each place: of the blocks before, of the words of the block before this one, of this word."""
    word, bit = place >> 6, (place & 63).astype(np.uint64)
    rank = directory[place // BLOCK].astype(np.int64)
    first = place // BLOCK * (BLOCK // 64)
    for k in range(BLOCK // 64 - 1):
        inside = first + k < word
        rank += np.where(inside, np.bitwise_count(words[np.where(inside, first + k, 0)]), 0)
    return rank + np.bitwise_count(words[word] & ((np.uint64(1) << bit) - np.uint64(1)))


class Codes:
    """A sequence of unsigned 32-bit values; ``take`` reads any of them."""

    def __init__(self, size: int, levels: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]):
        self.size, self.levels = size, levels

    @classmethod
    def of(cls, values: np.ndarray) -> Codes:
        rest = values.astype(np.uint32, copy=False)
        levels = []
        plan = widths(rest)
        for k, width in enumerate(plan):
            chunks = packed_bits(rest, width)
            if k == len(plan) - 1:
                levels.append((width, chunks, np.zeros(0, np.uint64), np.zeros(0, np.uint32)))
                break
            more = rest > np.uint32((1 << width) - 1)
            padded = np.zeros(-(-len(more) // BLOCK) * BLOCK, np.uint8)
            padded[: len(more)] = more
            words = np.packbits(padded, bitorder="little").view("<u8")
            ones = np.bitwise_count(words).reshape(-1, BLOCK // 64).sum(1)
            directory = (np.cumsum(ones) - ones).astype(np.uint32)
            levels.append((width, chunks, words, directory))
            rest = rest[more] >> np.uint32(width)
        return cls(len(values), levels)

    def take(self, place: np.ndarray) -> np.ndarray:
        """The values at the given places, in their order."""
        place = np.asarray(place, np.int64)
        result = np.zeros(len(place), np.uint32)
        active, shift = np.arange(len(place)), 0
        for width, chunks, words, directory in self.levels:
            result[active] |= read_bits(chunks, width, place) << np.uint32(shift)
            if not len(words):
                break
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            on = ((words[word] >> bit) & np.uint64(1)).astype(bool)
            active, place = active[on], place[on]
            place, shift = set_before(words, directory, place), shift + width
        return result

    def between(self, start: int, end: int) -> np.ndarray:
        """The values at the places from ``start`` to before ``end``; a level is read from the place that its directory gives."""
        result, active, shift = np.zeros(end - start, np.uint32), np.arange(end - start), 0
        for width, chunks, words, directory in self.levels:
            if start == end:
                break
            result[active] |= unpacked_bits(chunks, width, start, end) << np.uint32(shift)
            if not len(words):
                break
            bits = np.unpackbits(words.view(np.uint8)[start >> 3 : -(-end // 8)], bitorder="little")
            active = active[bits[start & 7 :][: end - start].astype(bool)]
            start = int(set_before(words, directory, np.array([start]))[0])
            end, shift = start + len(active), shift + width
        return result

    def to_bytes(self) -> bytes:
        parts = [struct.pack("<QI", self.size, len(self.levels))]
        for width, chunks, words, directory in self.levels:
            parts.append(struct.pack("<IQQQ", width, len(chunks), len(words), len(directory)))
            parts += [chunks.tobytes(), words.astype("<u8").tobytes(), directory.astype("<u4").tobytes()]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> Codes:
        """Views of the bytes; nothing is decoded."""
        size, n = struct.unpack_from("<QI", data, at)
        at += 12
        levels = []
        for _ in range(n):
            width, n_chunks, n_words, n_blocks = struct.unpack_from("<IQQQ", data, at)
            at += 28
            chunks = np.frombuffer(data, np.uint8, n_chunks, at)
            words = np.frombuffer(data, "<u8", n_words, at + n_chunks)
            directory = np.frombuffer(data, "<u4", n_blocks, at + n_chunks + 8 * n_words)
            at += n_chunks + 8 * n_words + 4 * n_blocks
            levels.append((width, chunks, words, directory))
        return cls(size, levels)

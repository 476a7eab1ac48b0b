"""Letter, number, space or other, and lower case, as a vocabulary file's library sees them.

Unicode grows, and the tables of Python and of the library are of different age, so classes come from the
library's own pre-tokenizer: a worker asks it about each code point when it first meets it. Texts made of
long-settled ranges are folded by Python, which agrees there; all others by the library's normaliser.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from vanewatch.llm import textarrays as ta

#: Anything outside ranges whose case and composition no Unicode version since 2017 has changed.
UNSETTLED = re.compile("[^\x00-ԯ֑-ۿḀ-῿‐- ‰-⁞₠-₿←-⏾、-ヿ一-鿪가-힣]")
LINE = 4096


class Alphabet:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer  # only tasks need it

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.whole = Tokenizer.from_file(path)
        #: for texts that are folded already
        self.plain = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "added_tokens": []}))
        self.class_of = np.zeros(0x110000, np.uint8)
        self.known = np.zeros(0x110000, bool)

    def folded(self, text: str) -> str:
        """NFC and lower case."""
        if UNSETTLED.search(text):
            return self.whole.normalizer.normalize_str(text)
        return ta.folded(text)

    def kinds(self, points: np.ndarray) -> np.ndarray:
        """The class of every code point."""
        known = self.known[points]
        if not known.all():
            fresh = np.unique(points[~known])
            for at in range(0, len(fresh), LINE):
                self._ask(fresh[at : at + LINE])
        return self.class_of[points]

    def _ask(self, points: np.ndarray) -> None:
        """Letters join letters, others join others; what joins neither is a number, or a space if nothing is left of it."""
        left, _ = self._between(points, "a")
        other, seen = self._between(points, "!")
        self.class_of[points] = np.select([left, other, seen], [ta.LETTER, ta.OTHER, ta.NUMBER], ta.SPACE)
        self.known[points] = True

    def _between(self, points: np.ndarray, frame: str) -> tuple[np.ndarray, np.ndarray]:
        """Which code points join a frame character on both sides, and which are part of any pre-token."""
        line = "".join(f"{frame}{chr(c)}{frame}\n" for c in points)
        spans = np.array([span for _, span in self.plain.pre_tokenizer.pre_tokenize_str(line)], np.int64)
        joined, seen = np.zeros(len(points), bool), np.zeros(len(points), bool)
        begin, end = spans[:, 0], spans[:, 1]
        joined[begin[end - begin == 3] // 4] = True
        inside = (begin % 4 <= 1) & (end > begin // 4 * 4 + 1)
        seen[begin[inside] // 4] = True
        return joined, seen


def alphabet(path: str) -> Alphabet:
    return ta.once(("alphabet", path), lambda: Alphabet(path))

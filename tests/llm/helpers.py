"""Small documents with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, kept string, key string, rank int"


def awkward_texts() -> list[str | None]:
    rng = random.Random(4)
    vocabulary = ["the", "of", "and"] + ["".join(rng.choice("abcdeghilmnorstu") for _ in range(rng.randrange(3, 9))) for _ in range(300)]

    def prose(n: int) -> str:
        return " ".join(rng.choice(vocabulary) for _ in range(n)) + "."

    base, passage, line = prose(120), prose(40), prose(12)
    near = base.split(" ")
    near[60] = "changed"
    far = base.split(" ")
    far[10:60:6] = ["other"] * len(far[10:60:6])
    return [
        base, base, base.replace(" ", "\n", 7), " ".join(near), " ".join(far),
        prose(80) + " " + passage, passage + " " + prose(30), prose(50) + "\n" + line + "\n" + line + "\n" + prose(9),
        "\n".join([line] * 30), "ab " * 400, "x" * 9000, prose(3000), None, None, "", "   \n\t", "one", "one two", "Ääß Σ é 日本語 don't 12",
        "<|endoftext|> the <|startoftext|>", prose(150).upper(), "| " + " | ".join(vocabulary[:60]), passage, prose(25),
    ]


def awkward_documents(spark):
    """Nulls in every column, repeated rows and columns whose names the operators use themselves."""
    texts = awkward_texts()
    rows = []
    for i, text in enumerate(texts):
        lang = None if i % 7 == 3 else ("en", "de")[i % 2]
        source = None if i % 5 == 4 else f"s{i % 3}"
        rows.append((i, text, lang, source, None if i % 4 else len(text or ""), -i, "kept", None, i))
    return spark.createDataFrame(rows, DOCS)


def with_repeats(docs):
    """The documents, one of them twice more, and rows without an id."""
    twice = docs.where("doc_id = 5")
    nameless = docs.where("doc_id in (0, 3, 16)").selectExpr("cast(null as long) as doc_id", *docs.columns[1:])
    return docs.unionByName(twice).unionByName(twice).unionByName(nameless)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def base_figures(text: str | None) -> tuple[int, ...]:
    w = words(text)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    seen = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if seen[x] > 1 for k in range(8)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def shingles(text: str | None, size: int) -> frozenset:
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1)))


def linked(texts: dict[int, str | None], size: int, percent: int) -> dict[int, int]:
    """Smallest id of each document's component."""
    sets = {i: shingles(t, size) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}


def without_repeats(texts: dict[int, str | None], length: int) -> dict[int, tuple]:
    data = {i: (t or "").encode() for i, t in texts.items()}
    first: dict[bytes, int] = {}
    for i in sorted(data):
        for p in range(len(data[i]) - length + 1):
            first.setdefault(data[i][p : p + length], i)
    found = {}
    for i, b in data.items():
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        found[i] = len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()
    return found

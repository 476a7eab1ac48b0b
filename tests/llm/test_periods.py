"""Periodic runs of words against brute force."""

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import helpers
from vanewatch.llm import periods
from vanewatch.llm.queries import QUERIES, with_planted_periods


def runs_by_force(w, min_length=24, min_repeats=3):
    """(start, period, length) of all runs."""
    found = {}
    for q in range(1, len(w) // min_repeats + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(min_length, min_repeats * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, q, e - s) for (s, e), q in found.items())


def collapsed_by_force(w, runs):
    gone = {i for s, q, n in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


@st.composite
def repetitive(draw):
    words = []
    for _ in range(draw(st.integers(0, 5))):
        block = draw(st.lists(st.sampled_from("abc"), min_size=1, max_size=9))
        words += (block * 14)[: draw(st.integers(1, 60))]
    return " ".join(words)


@settings(max_examples=150, deadline=None)
@given(st.lists(repetitive(), min_size=1, max_size=4), st.sampled_from([24, 6]), st.sampled_from([3, 4]))
def test_runs_by_force(texts, min_length, min_repeats):
    _, symbols, starts = periods.split_words(texts)
    s, e, q = periods.runs(symbols, starts, min_length, min_repeats)
    owner = np.searchsorted(starts, s, side="right") - 1
    for i, text in enumerate(texts):
        found = [(a - starts[i], c, b - a) for a, b, c, o in zip(s, e, q, owner, strict=True) if o == i]
        assert found == runs_by_force(text.split(), min_length, min_repeats)


def test_extensions_by_force():
    rng = np.random.default_rng(2)
    for words in (rng.integers(0, 2, 400), np.zeros(300, np.int64), np.tile(rng.integers(0, 3, 40), 8)):
        words = np.append(words, 9)
        extend = periods.Extensions(words)
        i, j = rng.integers(0, len(words), (2, 500))
        i, j = i[i != j], j[i != j]
        for a, b, n in zip(i, j, extend(i, j), strict=True):
            k = 0
            while max(a, b) + k < len(words) and words[a + k] == words[b + k]:
                k += 1
            assert n == k


def test_grid_in_small_parts(monkeypatch):
    monkeypatch.setattr(periods, "POINTS", 1)
    text = "k " + "a b c d " * 9 + "x y " * 13 + "z"
    _, symbols, starts = periods.split_words([text, text])
    s, _, q = periods.runs(symbols, starts)
    assert q.tolist() == [4, 2, 4, 2] and len(s) == 4


def test_fewer_repeats_are_refused():
    with pytest.raises(ValueError):
        periods.runs(np.arange(30), np.array([0, 30]), 24, 2)


def test_awkward_documents(spark):
    docs = helpers.with_repeats(helpers.awkward_documents(spark))
    found = periods.periodic_runs(docs).collect()
    wanted = []
    for r in docs.collect():
        w = helpers.words(r.text)
        runs = runs_by_force(w)
        wanted.append((r.doc_id, len(w), [(s, n, q) for s, q, n in runs], collapsed_by_force(w, runs)))
    assert sorted(map(repr, wanted)) == sorted(repr((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed)) for r in found)
    assert periods.periodic_runs(docs.limit(0)).count() == 0


def test_long_text(spark):
    text = "start " + "a b a c " * 60_000 + "end"
    (row,) = periods.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [tuple(r) for r in row.runs] == [(1, 240_000, 4)] and row.collapsed == "start a b a c end"


def planted(doc_id, text):
    w = helpers.words(text)
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_query_on_a_fixture(spark, tmp_path):
    texts = helpers.awkward_texts()
    rows = [(i, texts[(i // 3) % len(texts)][:6000] if texts[(i // 3) % len(texts)] else None) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: helpers.words(r.text) for r in with_planted_periods(docs).collect()} == {i: planted(i, t) for i, t in rows}
    found = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(found) == len(rows)
    hashes = 0
    for i, text in rows:
        w, r = planted(i, text), found[i]
        runs = runs_by_force(w)
        hashes += bool(runs)
        best = min(runs, key=lambda x: (-Fraction(x[2], x[1]), x[0], x[1]), default=None)
        wanted = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *wanted)
        lines = "".join(f"{s},{n},{q}\n" for s, q, n in runs)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed_by_force(w, runs).encode()).hexdigest()
    assert hashes > 20

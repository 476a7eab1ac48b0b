"""Token counts, packing, near-duplicates, repeated passages and models on awkward input."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm import helpers
from vanewatch.llm.alphabet import alphabet
from vanewatch.llm import classifier, components, jaccard, language, packing, repeats, tokens
from vanewatch.llm.queries import VOCABULARY
from vanewatch.llm.suffixes import suffix_array


@pytest.fixture(scope="module")
def docs(spark):
    return helpers.awkward_documents(spark).cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'sdtrevlm éÉΣßİ1٣½\n\u0085\u00a0\u001c!<|>日😀\u0301")), min_size=1, max_size=4))
def test_token_counts_match_the_library(texts):
    library = Tokenizer.from_file(VOCABULARY)
    found = tokens.token_counts(texts, tokens.merges(VOCABULARY), alphabet(VOCABULARY), tokens.Memory())
    assert found.tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_every_code_point_in_three_contexts(library):
    """Counts and ids equal the library's, whatever the age of Python's Unicode tables."""
    letters, memory, encoder = alphabet(VOCABULARY), tokens.Memory(), packing.Encoder(VOCABULARY)
    # planes 3 to 16 hold hardly any letters: every 61st there (all of them take three minutes)
    points = [c for c in (*range(0x30000), *range(0x30000, 0x110000, 61)) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 1 << 17):
        some = [chr(c) for c in points[at : at + (1 << 17)]]
        texts = ["\n".join(f"a{c}b '{c}s 1{c}{c}!" for c in some[k : k + 64]) for k in range(0, len(some), 64)]
        wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert tokens.token_counts(texts, tokens.merges(VOCABULARY), letters, memory).tolist() == [len(w) for w in wanted]
        assert [row.tolist() for row in encoder.encode(texts)] == wanted


def test_counted_tokens(docs, texts, library):
    found = tokens.counted_tokens(helpers.with_repeats(docs), VOCABULARY, limit=100).collect()
    assert len(found) == helpers.with_repeats(docs).count()
    for r in found:
        if r.doc_id is not None:
            text = texts[r.doc_id] or ""
            n = len(library.encode(text, add_special_tokens=False).ids)
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 100)


def test_memory_forgets():
    memory = tokens.Memory(most=4)
    memory.add(np.array([1, 5], np.uint64), np.array([10, 50]))
    memory.add(np.array([2, 3, 9], np.uint64), np.array([20, 30, 90]))
    value, unknown = memory.find(np.array([1, 3], np.uint64))
    assert unknown.tolist() == [True, False] and value[1] == 30


def test_packed_sequences(docs, texts, library):
    capacity = 256
    found = packing.packed(helpers.with_repeats(docs), VOCABULARY, capacity=capacity).collect()
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t in texts.items()}
    pieces, bins = Counter(), defaultdict(list)
    for r in found:
        if r.doc_id is not None:
            part = ids[r.doc_id][r.start : r.start + r.length]
            assert r.start == r.piece * capacity and r.ids == part
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            pieces[r.doc_id] += r.length
        bins[r.sequence_id].append((r.offset, r.length))
    assert pieces == Counter({i: len(x) * (3 if i == 5 else 1) for i, x in ids.items()})
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), min_size=1))
def test_plan_places_every_piece_once(counts):
    total, used = defaultdict(int), defaultdict(int)
    for length, first, last, times, sequence, _ in packing.plan(counts, 40):
        assert first == total[length] and (last - first) % times == 0
        total[length] = last
        for s in range((last - first) // times):
            used[sequence + s] += times * length
    assert dict(total) == counts and max(used.values()) <= 40


def test_fullest_combination_by_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        left = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(6)}
        sums = {max(left)}
        for length, n in left.items():
            n -= length == max(left)
            sums = {s + k * length for s in sums for k in range(n + 1) if s + k * length <= 50}
        chosen = packing.fullest(dict(left), 50)
        assert sum(k * n for k, n in chosen.items()) == max(sums) and all(n <= left[k] for k, n in chosen.items())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60))
def test_suffix_array(symbols):
    text = [*symbols, 0]
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_ids_of_a_very_long_word(library):
    """A word of fewer than 2^20 letters may have more than 2^20 ids."""
    texts = ["one two", "ᄒ" * 540_000, "two three"]
    found = packing.Encoder(VOCABULARY).encode(texts)
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(expected[1]) >= 1 << 20
    assert [f.tolist() for f in found] == expected


def test_repeated_passages(docs, texts):
    found = repeats.without_repeats(docs, length=50, keep_text=True).collect()
    expected = helpers.without_repeats(texts, 50)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == expected
    assert all(r.n_removed == sum(s.end - s.start for s in r.spans) == r.n_bytes - len(r.kept) for r in found)


def test_repeated_passages_in_segments(monkeypatch):
    """Long texts are cut into segments; cuts must not hide or add matches."""
    rng = random.Random(5)
    body = "".join(rng.choice("abc ") for _ in range(700))
    uids, texts = [1, 2, 3], [body, body[100:400] + "zz" + body[350:], body[::-1] + body[500:580]]
    whole = repeats.Blocks(uids, texts, 20)
    monkeypatch.setattr(repeats, "SEGMENT", 64)
    cut = repeats.Blocks(uids, texts, 20)
    for blocks in (whole, cut):
        starts = sorted((u, s + k) for u, s, n in zip(blocks.uid, blocks.start, blocks.end - blocks.first, strict=True) for k in range(n - 19))
        assert starts == [(u, s) for u, t in zip(uids, texts, strict=True) for s in range(len(t) - 19)]


def test_blocks_with_like_hashes_are_told_apart():
    """Different blocks of one anchor whose hashes agree in their upper 32 bits lose nothing by their hashes."""
    values = [[7, 7], [1, 1], [5 << 32 | 1, 5 << 32 | 2], [1, 2], [0, 0], [60, 60]]
    columns = [np.array(v, kind) for v, (kind, _) in zip(values, repeats._KINDS, strict=True)]
    body = b"".join(c.tobytes() for c in columns)
    batch = pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([body], pa.binary())], ["slot", "body"])
    found = [r for b in repeats._match_hashes(0)([batch]) for r in b.to_pylist()]
    assert [r["uid"] for r in found if r["uid"] is not None] == []
    assert [r["anchor"] for r in found if r["anchor"] is not None] == [1 << 32 | 7]


def test_repeats_of_a_hot_passage(spark, monkeypatch):
    """Blocks of an anchor that many documents have are dealt over tasks; a batch sends two hashes of it."""
    rng = random.Random(11)
    own = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = own(90)
    texts = {i: own(30 + i % 7) + passage + own(i % 60) + (passage[20:] if i % 5 == 0 else "") for i in range(80)}
    texts |= {i: texts[i - 80][:100] + "#" + own(20) for i in range(80, 100)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    monkeypatch.setattr(repeats, "HOT", 6)
    found = repeats.without_repeats(docs, length=50).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == helpers.without_repeats(texts, 50)
    batch = pa.RecordBatch.from_arrays([pa.array(list(texts)), pa.array(list(texts.values()))], ["uid", "text"])
    sent = [r for b in repeats._send_hashes(50, 1, 0)([batch]) for r in b.to_pylist() if r["slot"] == 0]
    assert max(Counter(repeats.Blocks(list(texts), list(texts.values()), 50).anchor.tolist()).values()) >= 50
    n = sum(len(r["body"]) for r in sent) // repeats._ROW
    low = np.frombuffer(sent[0]["body"], np.uint32, n)
    assert max(Counter(low.tolist()).values()) == 2


def repeats_by_force(rows, length):
    """(id, n_bytes, n_removed, sha) of rows (id, text); only a smaller id counts, null is above all ids."""
    order = lambda i: (i is None, i or 0)
    data = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in data:
        for p in range(len(b) - length + 1):
            first[b[p : p + length]] = min(first.get(b[p : p + length], (2, 0)), order(i))
    found = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < order(i):
                gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        found.append((i, len(b), sum(gone), hashlib.sha256(kept).hexdigest()))
    return found


@pytest.mark.parametrize("hot", [4096, 3])
def test_repeats_with_nulls_and_shared_ids(spark, docs, monkeypatch, hot):
    """Rows of one id take nothing from each other, equal or not; neither do rows without an id."""
    monkeypatch.setattr(repeats, "HOT", hot)
    rng = random.Random(2)
    own = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = own(100)
    rows = [(r.doc_id, r.text) for r in helpers.with_repeats(docs).select("doc_id", "text").collect()]
    rows += [(100 + i // 3, own(20) + passage[: 60 + i] + own(20)) for i in range(9)]
    rows += [(None, own(9) + passage), (None, passage + own(60)), (200, passage), (200, passage), (201, None)]
    found = repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), length=50).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in found) == Counter(repeats_by_force(rows, 50))


@pytest.mark.parametrize(("size", "percent", "part"), [(3, 90, 4_000_000), (5, 80, 4_000_000), (3, 70, 200)])
def test_components_of_near_copies(docs, texts, size, percent, part):
    found = jaccard.linked_components(docs, size, percent, part=part).collect()
    expected = helpers.linked(texts, size, percent)
    assert {r.doc_id: r.component_id for r in found} == expected
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(helpers.shingles(t, size)) for i, t in texts.items()}


def test_near_copies_keep_one(docs, texts):
    kept = jaccard.keep_one(helpers.with_repeats(docs), 5, 80)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    expected = Counter({i: 1 for i, root in helpers.linked(texts, 5, 80).items() if root == i})
    assert ids == expected


def test_chain_of_near_copies(spark):
    """Neighbours link, ends do not: one component, also when the block is dealt over parts."""
    rng = random.Random(6)
    w = [f"w{rng.randrange(10**6)}" for _ in range(100)]
    rows = []
    for i in range(30):
        rows.append((i, " ".join(w)))
        w[3 * i + 2] = f"n{i}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for part in (4_000_000, 300):
        assert {r.component_id for r in jaccard.linked_components(docs, 3, 90, part=part).collect()} == {0}


def test_components(spark):
    pairs = [(i + 1, i) for i in range(20)] + [(40, 30), (41, 30), (42, 41), (5, 5)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 21)}, 40: 30, 41: 30, 42: 30}


LANGUAGES = {
    "en": "the house and the garden of an old friend was there with that thing this other",
    "de": "das haus und der garten von einem alten freund war dort mit dem ding nicht schön",
}


def test_language(spark):
    rng = random.Random(7)
    rows = []
    for i in range(60):
        lang = ("en", "de")[i % 2]
        rows.append((i, " ".join(rng.choice(LANGUAGES[lang].split()) for _ in range(12)), lang))
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en"]
    names, score = language.predict(model, ["the garden thing", "der garten haus", "freundes hause schöner", "", "12 !", "жук", "THE OTHER"])
    assert names[:5] == ["en", "de", "de", "und", "und"] and names[6] == "en"
    assert all(0 <= s <= 1 for s in score) and score[3] == score[4] == 0
    # an unseen word falls back to its n-grams
    assert language.predict(model, ["gartenhaus"])[0] == ["de"]


def test_language_rows(spark, docs):
    model = language.learn(docs.where("doc_id < 12"))
    rows = helpers.with_repeats(docs)
    found = language.identified(rows, model).collect()
    assert len(found) == rows.count()
    assert {r.lang_pred for r in found if r.doc_id in (12, 13, 14, 15)} == {"und"}
    nothing = language.learn(docs.limit(0))
    assert {r.lang_pred for r in language.identified(docs, nothing).collect()} == {"und"}


def test_classifier(spark):
    rng = random.Random(8)
    good, bad = "river stone morning quiet letter window".split(), "BUY!! CHEAP!! NOW!! $$$ CLICK!!".split()
    rows = [(i, " ".join(rng.choice(bad if i % 4 == 0 else good) for _ in range(30))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(160)] + [(None, 1), (3, None)], "doc_id long, label int")
    model = classifier.learn(docs, labels)
    score = {r.doc_id: r.score for r in classifier.scored(docs, model).collect()}
    assert all((score[i] >= 0.3) == (i % 4 != 0) for i in range(160, 200))
    again = classifier.learn(docs, labels)
    assert np.array_equal(model.weight, again.weight)


def test_classifier_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, label int")
    rows = helpers.with_repeats(docs)
    found = classifier.scored(rows, classifier.learn(rows, none)).collect()
    assert len(found) == rows.count() and {r.score for r in found} == {0.5}


@pytest.mark.parametrize(
    "run",
    [
        lambda d: tokens.counted_tokens(d, VOCABULARY), lambda d: packing.packed(d, VOCABULARY), lambda d: repeats.without_repeats(d),
        lambda d: jaccard.linked_components(d), lambda d: jaccard.keep_one(d),
    ],
)
def test_empty_tables(docs, run):
    assert run(docs.limit(0)).count() == 0

"""Quality rules, exact de-duplication, mixing and URL filters on awkward input, by brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import helpers
from vanewatch.llm import chunks, mixing, rules, urls
from vanewatch.llm.queries import QUERIES


@pytest.fixture(scope="module")
def docs(spark):
    return helpers.awkward_documents(spark).cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def test_quality_figures(docs, texts):
    limits = rules.Limits(guard_reference=100)
    found = rules.quality_verdicts(docs, limits).collect()
    assert len(found) == len(texts)
    for r in found:
        figures = helpers.base_figures(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == figures, r.doc_id
        assert r.base_failed == (figures[0] < 20 or 100 * figures[4] > 30 * figures[0])
        assert not (r.base_failed and r.kept)
        for distance in (r.class_distance, r.word_distance):
            assert distance is None or 0 <= distance <= 1


def test_many_repeated_windows_are_sorted(spark):
    text = " ".join(f"w{i % 150}" for i in range(500)) + " " + " ".join(f"z{i}" for i in range(60))
    found = rules.quality_verdicts(spark.createDataFrame([(1, text, None, None)], "doc_id long, text string, lang string, source string"))
    assert found.first().n_repeat_words == helpers.base_figures(text)[4]


def test_distance(spark):
    def distance(p, q):
        p, q = (np.array(x) / sum(x) for x in (p, q))
        m = (p + q) / 2
        kl = [sum(a * np.log2(a / b) for a, b in zip(x, m, strict=True) if a) for x in (p, q)]
        return (sum(kl) / 2) ** 0.5

    row = spark.createDataFrame([([3, 0, 5], [1, 4, 1]), ([0, 0, 0], [1, 1, 1])], "p array<bigint>, q array<bigint>")
    got = [r[0] for r in row.select(rules.js_distance(F.col("p"), F.col("q"))).collect()]
    assert got[0] == pytest.approx(distance([3, 0, 5], [1, 4, 1])) and got[1] is None


def test_keep_good_keeps_columns(docs):
    kept = rules.keep_good(helpers.with_repeats(docs))
    assert kept.columns == docs.columns
    rows = [r.doc_id for r in kept.collect()]
    assert rows.count(5) == 3 and None in rows and 14 not in rows and 9 not in rows


def test_references_tell_tables_from_prose(spark):
    prose = " ".join(["the", "house", "of", "sand", "and", "fog", "is", "near"] * 40).split(" ")
    rows = [(i, " ".join(prose[i % 8 : 260 + i % 8] + [f"u{i}x{k}" for k in range(300)]), "en", None) for i in range(40)]
    rows.append((99, "| " + " | ".join(f"Q{k}X" for k in range(400)), "en", None))
    found = rules.quality_verdicts(
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), rules.Limits(repeat_percent=100)
    )
    assert {r.doc_id for r in found.collect() if not r.kept} == {99}


def test_common_words_of_any_language(spark, monkeypatch):
    """Learned by number of documents, ties in order; case and punctuation do not matter; null is a language."""
    monkeypatch.setattr(rules, "COMMON", 3)
    rows = [("x", "Zu zu ZU (zu), am ort."), ("x", "am zu \u00e9t!"), ("x", "ort; [am]"), ("y", "ka"), (None, "ort ort"), (None, None), ("z", "...")]
    texts = spark.createDataFrame(rows, "_lang string, _text string").withColumn("_text", F.coalesce("_text", F.lit("")))
    hashed = {r.h: r.w for r in spark.createDataFrame([(w,) for w in ("zu", "am", "ort", "ka")], "w string").withColumn("h", F.xxhash64("w")).collect()}
    got = {r.common_lang: [hashed[h] for h in r.common] for r in rules.common_words(texts, 3).collect()}
    assert got == {"x": ["am", "ort", "zu"], "y": ["ka"], None: ["ort"]}


def exact_expected(texts):
    plain = {i: re.sub(r"[\x20\x09-\x0D]+", "", t or "") for i, t in texts.items()}
    sizes = Counter(plain.values())
    best = {}
    for i, p in plain.items():
        rank = (-len(texts[i] or ""), i)
        best[p] = min(best.get(p, rank), rank)
    return {
        i: (best[p][1], sizes[p], best[p][1] == i, hashlib.sha256(p.encode()).hexdigest()) for i, p in plain.items()
    }


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_groups(docs, texts, bits):
    """With three bits most identifiers clash, and sums must take their place."""
    found = chunks.exact_groups(docs, bits=bits).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found} == exact_expected(texts)


def test_exact_keep_one(docs, texts):
    kept = chunks.keep_one(helpers.with_repeats(docs))
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == sorted({e[0] for e in exact_expected(texts).values()})


def test_chunk_cuts_cover_long_texts(spark):
    text = "a" * 10_000 + "." + "b" * 300 + "! " + "c" * 5
    pieces = chunks.recipe_rows(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert len(pieces.recipe) == 5 and pieces.points == len(text)


def test_mixture_meets_targets(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(["w"] * int(n)), f"s{int(s)}" if s else None) for i, (n, s) in enumerate(zip(rng.integers(0, 200, 900), rng.integers(0, 4, 900), strict=True))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    runs = [sorted(mixing.mixture(docs, fan=fan).collect()) for fan in (4096, 16, 16)]
    assert runs[1] == runs[2]
    for run in runs[:2]:
        taken = Counter()
        for r in run:
            assert r.taken == r.copies * r["size"] <= 2 * r["size"]
            taken[r.source] += r.taken
        targets = {r.source: (r.target, r.source_size) for r in run}
        total = sum(s for _, s in targets.values())
        assert sum(t for t, _ in targets.values()) == pytest.approx(1.5 * total)
        for source, (target, size) in targets.items():
            assert target <= 2 * size + 1e-6 and abs(taken[source] - target) <= 0.02 * target


def test_mixture_of_many_repeats_meets_targets(spark):
    """Identical rows that hold much of a source count with all their words.

    A source misses its target by its last open document: a small one, or any one where groups are tiny.
    """
    rows = [(None, "w " * 40, "a")] * 333 + [(7, "v " * 30, "b")] * 50 + [(7, "v " * 30, None)] * 9
    rows += [(100 + i, f"u{i} " * (1 + i % 9), ("a", "b", None)[i % 3]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    for fan in (4096, 4):
        found = mixing.mixture(docs, fan=fan).collect()
        assert len(found) == len(rows)
        taken, targets = Counter(), {}
        for r in found:
            taken[r.source] += r.taken
            targets[r.source] = r.target
        assert all(abs(taken[s] - t) <= (10 if fan > 100 else 40) for s, t in targets.items())
        words = Counter()
        for r in mixing.mixed(docs, fan=fan).collect():
            words[r.source] += len(r.text.split())
        assert words == taken


def whole_path(size, x, rng):
    """Both levels of the tree: two groups, then what is left of them."""
    x, left = x.copy(), []
    for group in (np.array([0, 2, 3]), np.array([1, 4, 5])):
        x[group], held = mixing.pivot(size[group], x[group], rng.random(3))
        left += [group[held]] if held >= 0 else []
    left = np.array(sorted(left), int)
    if len(left):
        x[left], held = mixing.pivot(size[left], x[left], rng.random(len(left)), last=True)
        assert held == -1
    return x


@pytest.mark.parametrize("fractions", [[0.3] * 6, [0.5, 0.1, 0.9, 0.25, 0.6, 0.3]])
@pytest.mark.parametrize("one_group", [True, False])
def test_mixture_shares_rounding_fairly(fractions, one_group):
    """Over many draws of the whole path the mean of each document's copies is its fraction."""
    size, x, rng = np.array([50.0, 40, 30, 20, 10, 5]), np.array(fractions), np.random.default_rng(2)
    draws = []
    for _ in range(5000):
        draws.append(mixing.pivot(size, x, rng.random(6), last=True)[0] if one_group else whole_path(size, x, rng))
    draws = np.array(draws)
    assert set(draws.ravel()) == {0.0, 1.0}
    assert np.abs(draws.mean(0) - x).max() < 0.02


def test_pivot_keeps_the_words():
    rng = np.random.default_rng(2)
    for _ in range(500):
        size, x = np.sort(rng.integers(0, 60, 9))[::-1].astype(float), rng.random(9)
        got, held = mixing.pivot(size, x, rng.random(9))
        assert abs((got * size).sum() - (x * size).sum()) < 1e-6
        assert all(v in (0, 1) for i, v in enumerate(got) if i != held)


def targets_by_force(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets of sources by their sizes: caps are found one after the other."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    held = {}
    while True:
        left = share * sum(sizes.values()) - sum(held.values())
        free = [s for s in order if s not in held]
        wanted = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        over = [s for s in free if wanted[s] > most * sizes[s] + 1e-9]
        if not over:
            return held | wanted
        held |= {s: most * sizes[s] for s in over}


def test_mixture_by_force(spark, sf_dir):
    """The whole query: sizes, source sizes and targets by brute force, taken words within a document."""
    found = QUERIES["op1_mixing"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()
    size, by_source = {}, Counter()
    for d in docs:
        size[d.doc_id] = len(helpers.words(d.text))
        by_source[d.source] += size[d.doc_id]
    targets, taken = targets_by_force(dict(by_source)), Counter()
    assert sorted(r.doc_id for r in found) == sorted(size)
    source = {d.doc_id: d.source for d in docs}
    for r in found:
        s = source[r.doc_id]
        assert (r["size"], r.source_size) == (size[r.doc_id], by_source[s]) and r.target == pytest.approx(targets[s])
        assert r.taken in (0, r["size"], 2 * r["size"])
        taken[s] += r.taken
    largest = {s: max(size[i] for i in source if source[i] == s) for s in taken}
    assert all(abs(taken[s] - targets[s]) < largest[s] for s in taken)


def test_mixture_expands_repeats_in_slices(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_BITS", 2)
    docs = spark.createDataFrame([(1, "a b", "s")] * 23 + [(2, "c", "s")], "doc_id long, text string, source string")
    found = mixing.mixture(docs).collect()
    assert Counter(r.doc_id for r in found) == {1: 23, 2: 1} and abs(sum(r.taken for r in found) - 1.5 * 47) <= 2


def test_mixture_of_awkward_rows(docs):
    found = mixing.mixture(helpers.with_repeats(docs))
    assert found.count() == helpers.with_repeats(docs).count()
    assert all(r.taken == 0 for r in found.where("size = 0").collect())
    rows = mixing.mixed(docs)
    assert rows.columns == docs.columns
    copies = {r.doc_id: r.copies for r in mixing.mixture(docs).collect()}
    assert Counter(r.doc_id for r in rows.collect()) == Counter({i: n for i, n in copies.items() if n})


def url_expected(url, found, default="allow"):
    match = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (match[1].translate(str.maketrans(urls.UPPER, urls.LOWER)), match[2]) if match else ("", "")
    best = None
    for verdict, rule in found:
        rule_host, _, rest = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + rest):
            best = max(best or (0,), (len(rule), rule, verdict))
    return host, path, best[1] if best else None, best[2] if best else default


@pytest.mark.parametrize("slot_rows", [1_000_000, 2])
def test_url_rules(spark, slot_rows):
    found = [("block", "net/"), ("allow", "a.net/en/"), ("block", "a.net/en/x"), ("allow", "b.a.net/"), ("block", "org/f"), ("allow", "org/fr/")]
    seen = [
        None, "", "no scheme", "http://NET", "http://net/", "https://x.a.net/en/", "https://x.a.net/en/xy?q=/", "http://b.a.net/en/x",
        "http://c.b.a.net", "http://c.b.a.net/", "http://anet/en/", "ftp://u@org:80/fr/", "http://z.org/fr/é", "http://z.org/fr#/", "http://org/fq",
        "http://./", "http://a..net/x", "x://y://net/", "http://z.org/f\U0010ffff",
    ]
    rows = [(i, u, "h") for i, u in enumerate(seen)] + [(None, "http://q.net/1", "h")] * 3 + [(4, "http://net/", "h")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = urls.judged_urls(pages, urls.rule_table(spark, found), slot_rows=slot_rows).collect()
    expected = [(i, *url_expected(u, found)) for i, u, _ in rows]
    assert Counter(map(tuple, got)) == Counter(expected)


@pytest.mark.parametrize("rows_per_slice", [1_000_000, 3])
def test_rule_hosts_lie_on_one_stack(spark, rows_per_slice):
    """Nested rule hosts are open together; siblings, prefixes of labels and odd characters are not mixed up."""
    domains = ["net", "net.example", "net.example.a.b", "net.exam", "org", "com.x-y", "com.x"]
    hosts = ["net", "example.net", "a.example.net", "b.a.example.net", "c.b.a.example.net", "examples.net", "exam.net", "org", "x.com", "x-y.com",
             "q.x.com", "xy.com", "com", "", "..net", "net.", "n-et", "example.net-", "é.example.net", "z" * 300 + ".exam.net"]
    found = urls.open_domains(
        spark.createDataFrame([(h,) for h in hosts], "host string"), spark.createDataFrame([(d,) for d in domains], "domain string"), 4, rows_per_slice
    )
    got = {(r.host, r.domain) for r in found.collect()}
    assert got == {(h, d) for h in hosts for d in domains if (".".join(h.split(".")[::-1]) + ".").startswith(d + ".")}
    assert max(Counter(h for h, _ in got).values()) == 3


def test_url_filter_on_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.judged_urls(none, urls.rule_table(spark, [("block", "net/")])).count() == 0


def test_url_filter_without_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert urls.judged_urls(pages, urls.rule_table(spark, []), default="block").first().verdict == "block"


@pytest.mark.parametrize(
    "run",
    [
        lambda d: rules.quality_verdicts(d), lambda d: rules.keep_good(d), lambda d: chunks.exact_groups(d),
        lambda d: chunks.keep_one(d), lambda d: mixing.mixture(d), lambda d: mixing.mixed(d),
    ],
)
def test_empty_tables(docs, run):
    assert run(docs.limit(0)).count() == 0

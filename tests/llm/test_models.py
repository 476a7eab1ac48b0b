"""The two learned models next to plain loops over words and n-grams."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm import helpers
from vanewatch.llm import classifier, language
from vanewatch.llm.queries import QUERIES

WORD = re.compile(r"[^\W\d_]+")
ORDERS = (5, 4, 3, 2, 1)


def units(text):
    """(order, string) of all words (order 0) and n-grams of a text, in lower case."""
    for word in WORD.findall(text.lower()):
        yield 0, word
        for order in ORDERS:
            for i in range(len(word) - order + 1):
                yield order, word[i : i + order]


def learned_by_force(rows, most_words, most_grams, least=2):
    """Log frequencies by (order, string) and language, with the same smoothing."""
    counts = defaultdict(Counter)
    for text, lang in dict.fromkeys((t, x) for t, x in rows if x is not None and t is not None):
        for unit in units(text):
            counts[lang][unit] += 1
    chosen = set()
    for lang in counts:
        for order in (0, *ORDERS):
            ranked = [u for u in counts[lang] if u[0] == order]
            assert len(ranked) <= (most_grams if order else most_words), "ties would be cut by hash"
            chosen |= set(ranked)
    total = {u: sum(c[u] for c in counts.values()) for u in chosen}
    tables = defaultdict(dict)
    for u in chosen:
        if total[u] >= least:
            tables[u[0]][u[1]] = {lang: counts[lang][u] for lang in counts}
    logs = {}
    for order, table in tables.items():
        whole = {lang: sum(n[lang] for n in table.values()) for lang in counts}
        logs[order] = {s: {x: math.log((n[x] + 0.5) / (whole[x] + 0.5 * len(table))) for x in counts} for s, n in table.items()}
    return sorted(counts), logs


def predicted_by_force(model, text):
    languages, logs = model
    words = WORD.findall((text or "").lower())
    if not words or not languages:
        return "und", 0.0
    total = dict.fromkeys(languages, 0.0)
    for word in words:
        if word in logs.get(0, {}):
            for x in languages:
                total[x] += logs[0][word][x]
            continue
        for order in ORDERS:
            known = [word[i : i + order] for i in range(len(word) - order + 1) if word[i : i + order] in logs.get(order, {})]
            if known:
                for x in languages:
                    total[x] += sum(logs[order][g][x] for g in known) / len(known)
                break
    scaled = {x: total[x] / math.sqrt(len(words)) for x in languages}
    top = max(scaled.values())
    best = max(languages, key=lambda x: scaled[x])
    return best, 1 / sum(math.exp(v - top) for v in scaled.values())


def test_language_by_force(spark):
    """Every word, n-gram, smoothing and backoff step on a small table, repeated rows and nulls included."""
    rows = [("The garden of the house", "en"), ("the other things", "en"), ("the other things", "en"), ("Der Garten des Hauses", "de"),
            ("die anderen Dinge über", "de"), ("la maison et le jardin", "fr"), (None, "fr"), ("les autres", None), ("", "en")]
    table = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(rows)], "doc_id long, text string, lang string")
    model = language.learn(table)
    truth = learned_by_force(rows, 10_000, 5_000)
    assert model.languages == truth[0]
    texts = ["the garden", "Gartenhaus hauses", "jardins autre", "zzz", "", None, "x1y the2des", "thethethe other", "ÜBER überall", "12 !?"]
    found = language.identified(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), model).collect()
    for r in found:
        name, score = predicted_by_force(truth, texts[r.doc_id])
        assert (r.lang_pred, r.score) == (name, pytest.approx(score, abs=1e-9)), texts[r.doc_id]


def test_rare_languages_are_learned(spark):
    """The bounds hold per language: one text among thousands of another language counts."""
    many = [(i, f"word{chr(97 + i % 26)} common text number {chr(97 + i // 26 % 26)}{chr(97 + i % 7)}", "big") for i in range(2000)]
    rows = [*many, (9000, "petit jardin petit jardin", "rare"), (9000, "petit jardin petit jardin", "rare")]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most_rows=50, most_words=30, most_grams=40)
    assert model.languages == ["big", "rare"]
    assert language.predict(model, ["petit jardin", "common number"])[0] == ["rare", "big"]
    assert sum(len(t[0]) for t in model.tables.values()) <= 2 * (30 + 5 * 40)


def test_language_query_on_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op2_language_id"](spark, str(tmp_path)).count() == 0


def test_held_out_accuracy(spark, sf_dir):
    """Unseen documents of the supplied table: nearly all languages right, quality well ranked."""
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    found = [r for r in QUERIES["op2_language_id"](spark, sf_dir).collect() if r.held_out and docs[r.doc_id]]
    assert {r.doc_id for r in found} == {i for i, x in docs.items() if x and zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == docs[r.doc_id] for r in found) >= 0.97 * len(found) > 0


def features_by_force(text, buckets):
    """Hashed words and n-grams of a text with boundaries, as often as they occur, and marks of repeated pairs."""
    words = helpers.words(text)
    units = [("w", w) for w in words]
    for w in words:
        units += [(order, f" {w} "[i : i + order]) for order in classifier.ORDERS for i in range(len(w) + 2 - order + 1)]
    seen, again = set(), 0
    for pair in zip(words, words[1:]):
        again += pair in seen
        seen.add(pair)
    return Counter(units), again


def test_features_by_force():
    """Equal units share a bucket, no unit is lost or made up, texts do not mix."""
    texts = ["a bc abc", "", "abc abc abc abc", "x", "é日 b\tc\nbc", "long-word long-word " * 5]
    buckets = 1 << 20
    found = [[] for _ in texts]
    marks = Counter()
    for bucket, owner in classifier.features(texts, buckets):
        for b, o in zip(bucket.tolist(), owner.tolist(), strict=True):
            if b:
                found[o].append(b)
            else:
                marks[o] += 1
    for i, text in enumerate(texts):
        units, again = features_by_force(text, buckets)
        assert marks[i] == again
        assert sorted(Counter(found[i]).values()) == sorted(units.values())


def test_descent_and_score_by_force():
    """The steps next to plain loops; a document's score is the softmax of the mean of its vectors."""
    rng = np.random.default_rng(1)
    bags = [(np.sort(rng.choice(8, n, replace=False)).astype(np.uint32), np.full(n, 1 / n, np.float32)) for n in (1, 3, 2, 4)]
    bags.append((np.zeros(0, np.uint32), np.zeros(0, np.float32)))
    label, size, epochs, rate = np.array([0, 1, 1, 0, 1]), 3, 4, 0.5
    model = classifier.descend(bags, label, 8, size, epochs, rate, seed=7)
    draw = np.random.default_rng(7)
    vectors = (draw.random((8, size)) - 0.5) / size
    layer, bias, done = np.zeros((2, size)), np.zeros(2), 0
    for _ in range(epochs):
        for i in draw.permutation(5):
            now = rate * (1 - done / (epochs * 5))
            done += 1
            hidden = sum((share * vectors[b] for b, share in zip(*bags[i], strict=True)), np.zeros(size))
            odds = np.exp(layer @ hidden + bias)
            error = odds / odds.sum() - np.eye(2)[label[i]]
            for b, share in zip(*bags[i], strict=True):
                vectors[b] = vectors[b] - now * math.sqrt(len(bags[i][0])) * share * (error @ layer)
            layer = layer - now * np.outer(error, hidden)
            bias = bias - now * 0.1 * error
    assert np.allclose(model.weight, vectors @ (layer[1] - layer[0]), atol=1e-5) and model.bias == pytest.approx(bias[1] - bias[0], abs=1e-5)

    big = classifier.Model(rng.normal(size=1 << 12).astype(np.float32), 0.3)
    texts = ["some words some words", "", "other"]
    for text, got in zip(texts, classifier.score(big, texts), strict=True):
        used = [b for bucket, _ in classifier.features([text], 1 << 12) for b in bucket.tolist()]
        mean = np.mean(big.weight[used]) if used else 0.0
        assert got == pytest.approx(1 / (1 + math.exp(-mean - 0.3)), abs=1e-5)


def test_one_row_an_id_is_learned(spark):
    """An id that fills the table adds one row to the sample; contradicting labels count as 1."""
    rows = [(1, f"text {i}") for i in range(50)] + [(2, "good text"), (3, None), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (3, 0), (None, 1), (2, None)], "doc_id long, label int")
    model = classifier.learn(docs, labels)
    again = classifier.learn(docs.repartition(5), labels)
    assert np.array_equal(model.weight, again.weight) and model.bias == again.bias
    assert classifier.scored(docs.limit(0), model).count() == 0

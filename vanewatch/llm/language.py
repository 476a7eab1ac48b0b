"""Language identification by word-first backoff.

Learned words are scored by their log frequency in each language. A word that was not learned is
scored by its character n-grams of the longest order of which at least one is known, else by the next
shorter order; a word without any known n-gram says nothing. A document's scores are the sums over its
words (runs of letters, lower case); ``score`` is the share of the best language after a softmax of
the sums over the square root of the number of words.

The model is learned from a bounded sample of labelled texts, ``most_rows`` of each language, and holds
the ``most_words`` most frequent words and ``most_grams`` n-grams of each order of each language, so its size
grows with the number of languages only and a rare language is learned like any other. Equal texts of a
language are learned once; ids play no part.
Only text is looked at when predicting. A text that is null or has no letter gets ``und`` with score 0,
and so does every text if there was nothing to learn from. Ties go to the first language in
code-point order; repeated rows are judged one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewatch.llm import textarrays as ta
from vanewatch.llm.frames import in_pieces
from vanewatch.llm.sampling import bounded_by_group
from vanewatch.session import materialized

UNKNOWN = "und"
WORD = 0
ORDERS = (5, 4, 3, 2, 1)


@dataclass
class Model:
    languages: list[str]
    #: by order (WORD for words): sorted hashes and their log frequencies by language
    tables: dict[int, tuple[np.ndarray, np.ndarray]]


def letter_runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash prefix sums, text starts, and the starts and ends of the words."""
    points, starts = ta.code_points([ta.folded(t) for t in texts])
    if not len(points):
        nothing = np.zeros(0, np.int64)
        return np.zeros(1, np.uint64), starts, nothing, nothing
    kind = ta.classes()[points]
    begin, end = ta.runs(kind, starts)
    words = kind[begin] == ta.LETTER
    return ta.prefix_sums(points), starts, begin[words], end[words]


def grams(begin: np.ndarray, end: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all n-grams of words, and which word each is of."""
    n = np.maximum(end - begin - order + 1, 0)
    return ta.gathered(begin, n), np.repeat(np.arange(len(begin)), n)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, order, hash, n) of a batch of labelled texts."""
    for batch, texts in in_pieces(batches, "text"):
        langs, code = np.unique(np.array(batch.column(0).to_pylist(), dtype=object).astype(str), return_inverse=True)
        sums, starts, begin, end = letter_runs(texts)
        owner = code[np.searchsorted(starts, begin, side="right") - 1]
        for order in (WORD, *ORDERS):
            if order == WORD:
                hashes, lang = ta.run_hashes(sums, begin, end), owner
            else:
                place, word = grams(begin, end, order)
                hashes, lang = ta.run_hashes(sums, place, place + order), owner[word]
            for i, name in enumerate(langs):
                value, n = np.unique(hashes[lang == i], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(value), pa.string()), pa.array(np.full(len(value), order, np.int32)),
                        pa.array(value.astype(np.int64)), pa.array(n.astype(np.int64)),
                    ],
                    ["lang", "kind", "hash", "n"],
                )


def learn(
    labelled: DataFrame, most_rows: int = 1_500, most_words: int = 10_000, most_grams: int = 5_000, least: int = 2
) -> Model:
    """Learn from (text, lang) rows with a language; all bounds are per language."""
    rows = labelled.where("lang is not null and text is not null").select("lang", "text")
    rows = bounded_by_group(rows, "lang", "text", most_rows)
    counts = rows.mapInArrow(_count, "lang string, kind int, hash long, n long")
    counts = counts.groupBy("kind", "hash", "lang").agg(F.sum("n").alias("n"))
    counts = materialized(
        counts.selectExpr("*", "row_number() over (partition by lang, kind order by n desc, hash) as place"), "counts"
    )
    most = F.when(F.col("kind") == WORD, most_words).otherwise(most_grams)
    chosen = counts.where(F.col("place") <= most).select("kind", "hash").distinct()
    by_hash = counts.join(chosen, ["kind", "hash"]).groupBy("kind", "hash").agg(
        F.sum("n").alias("n"), F.collect_list(F.struct("lang", "n")).alias("langs")
    )
    kept = by_hash.where(F.col("n") >= least)
    found = kept.select("kind", "hash", F.inline("langs")).toPandas()  # bounded by most_words and most_grams of each language
    languages = sorted(found["lang"].unique(), key=lambda s: s.encode())
    code = {lang: i for i, lang in enumerate(languages)}
    tables = {}
    for kind, group in found.groupby("kind"):
        hashes, row = np.unique(group["hash"].to_numpy().astype(np.uint64), return_inverse=True)
        n = np.zeros((len(hashes), len(languages)))
        n[row, group["lang"].map(code)] = group["n"]
        tables[int(kind)] = hashes, np.log((n + 0.5) / (n.sum(axis=0) + 0.5 * len(hashes)))
    return Model(languages, tables)


def lookup(hashes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
    return place, table[place] == hashes


def word_scores(model: Model, sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Scores of words by language; zeros for a word that says nothing."""
    score = np.zeros((len(begin), len(model.languages)))
    open_ = np.arange(len(begin))
    if WORD in model.tables:
        hashes, logs = model.tables[WORD]
        place, known = lookup(ta.run_hashes(sums, begin, end), hashes)
        score[known] = logs[place[known]]
        open_ = open_[~known]
    for order in ORDERS:
        if not len(open_) or order not in model.tables:
            continue
        hashes, logs = model.tables[order]
        start, word = grams(begin[open_], end[open_], order)
        place, known = lookup(ta.run_hashes(sums, start, start + order), hashes)
        place, word = place[known], word[known]
        n = np.bincount(word, minlength=len(open_))
        for i in range(len(model.languages)):
            total = np.bincount(word, logs[place, i], len(open_))
            score[open_, i] = total / np.maximum(n, 1)
        open_ = open_[n == 0]
    return score


def predict(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    sums, starts, begin, end = letter_runs(texts)
    if not len(begin) or not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    owner = np.searchsorted(starts, begin, side="right") - 1
    _, example, which = np.unique(ta.run_hashes(sums, begin, end), return_index=True, return_inverse=True)
    scores = word_scores(model, sums, begin[example], end[example])
    words = np.bincount(owner, minlength=len(texts))
    total = np.stack([np.bincount(owner, s[which], len(texts)) for s in scores.T], axis=1)
    total /= np.sqrt(np.maximum(words, 1))[:, None]
    total = np.exp(total - total.max(axis=1, keepdims=True))
    share = total / total.sum(axis=1, keepdims=True)
    best = share.argmax(axis=1)
    names = [model.languages[b] if n else UNKNOWN for b, n in zip(best, words, strict=True)]
    return names, np.where(words > 0, share.max(axis=1), 0.0)


def identified(docs: DataFrame, model: Model, id_column: str = "doc_id") -> DataFrame:
    """One row per document: id, lang_pred, score. The model travels as a broadcast of bounded size."""
    kind = dict(docs.dtypes)[id_column]
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.tables))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in in_pieces(batches, "text"):
            names, score = predict(Model(*shared.value), texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(score)], ["id", "lang_pred", "score"]
            )

    thin = docs.select(F.col(id_column).alias("id"), F.col("text").alias("text"))
    found = thin.mapInArrow(run, f"id {kind}, lang_pred string, score double")
    return found.withColumnRenamed("id", id_column)

"""Quality classifier with supervised subword embeddings.

A text is the set of its words and the character n-grams of its words (with word boundaries), hashed
into buckets, and a mark for each pair of neighbouring words that the text had before. Every bucket has
a learned vector; a document is the average of its vectors, and a softmax layer gives the two classes.
Training is stochastic gradient descent in numpy, on a bounded sample of labelled rows (``most_rows``);
its size does not grow with the data. Since averaging and the layer are linear, scoring needs one
number per bucket.

Null and empty texts have no vectors and get the score of the bias alone. Rows without a label or with
a null id are not learned from; of labels that contradict each other 1 counts, and of several texts with one
id the one with the smallest MD5; repeated rows are scored one by one; without labelled rows every score is
0.5; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewatch.llm import textarrays as ta
from vanewatch.llm.frames import in_pieces
from vanewatch.llm.sampling import bounded

ORDERS = (3, 4, 5)
_SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


@dataclass
class Model:
    #: difference of the two classes' logits, by bucket, and the same for no text
    weight: np.ndarray
    bias: float


def features(texts: list[str], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket and text number of each word, n-gram and repeated pair, family by family, in text order."""
    points, starts = ta.code_points([f" {t} " for t in texts])
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(starts))
    space = np.zeros(256, bool)
    space[list(_SPACES)] = True
    gap = (points < 256) & space[np.minimum(points, 255)]
    points = np.where(gap, 0x20, points)
    sums = ta.prefix_sums(points)
    mask = np.uint64(buckets - 1)
    begin, end = ta.runs(gap.astype(np.uint8), starts)
    words = ~gap[begin]
    begin, end = begin[words], end[words]
    word = ta.run_hashes(sums, begin, end)
    # one bucket is kept for marks of repeated pairs
    yield (word & mask) % np.uint64(buckets - 1) + np.uint64(1), owner[begin]
    if len(word) > 1:
        pair = ta.mix(word[:-1] * np.uint64(3) + word[1:])
        same = owner[begin[:-1]] == owner[begin[1:]]
        keyed = ta.mix(pair + owner[begin[:-1]].astype(np.uint64))[same]
        first = np.zeros(len(keyed), bool)
        first[np.unique(keyed, return_index=True)[1]] = True
        again = owner[begin[:-1]][same][~first]
        yield np.zeros(len(again), np.uint64), again
    ink = (~gap).astype(np.int64)
    dark = np.concatenate([[0], np.cumsum(ink)])
    for order in ORDERS:
        if len(points) < order:
            continue
        # all but the two ends must be inside one word
        inside = dark[order - 1 :] - dark[1 : len(dark) - order + 2]
        at = np.flatnonzero(inside[: len(points) - order + 1] == order - 2)
        at = at[owner[at] == owner[at + order - 1]]
        value = ta.run_hashes(sums, at, at + order) ^ np.uint64(order)
        yield (value & mask) % np.uint64(buckets - 1) + np.uint64(1), owner[at]


def _bags(buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in in_pieces(batches, "text"):
            bags: list[list[np.ndarray]] = [[] for _ in texts]
            for bucket, owner in features(texts, buckets):
                cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
                for i, bag in enumerate(bags):
                    bag.append(bucket[cuts[i] : cuts[i + 1]])
            ids, counts = [], []
            for bag in bags:
                value, n = np.unique(np.concatenate(bag).astype(np.uint32), return_counts=True)
                ids.append(value.tobytes())
                counts.append(n.astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())],
                ["doc_id", "label", "ids", "counts"],
            )

    return run


def descend(
    bags: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, buckets: int, size: int, epochs: int, rate: float, seed: int
) -> Model:
    """Stochastic gradient descent, a document a step, with a falling rate."""
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((buckets, size)) - 0.5) / size).astype(np.float32)
    layer, bias = np.zeros((2, size), np.float32), np.zeros(2, np.float32)
    steps, done = epochs * len(bags), 0
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            ids, share = bags[i]
            now = rate * (1 - done / steps)
            done += 1
            hidden = share @ vectors[ids] if len(ids) else np.zeros(size, np.float32)
            logit = layer @ hidden + bias
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[label[i]] -= 1
            if len(ids):
                vectors[ids] -= (now * len(ids) ** 0.5) * share[:, None] * (p @ layer)
            layer -= now * np.outer(p, hidden)
            bias -= now * 0.1 * p
    return Model(vectors @ (layer[1] - layer[0]), float(bias[1] - bias[0]))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    most_rows: int = 3_000,
    buckets: int = 1 << 15,
    size: int = 16,
    epochs: int = 6,
    rate: float = 0.5,
    seed: int = 3,
) -> Model:
    """Learn from documents with a ``label`` (0 or 1) in ``labels``; at most about ``most_rows`` of them."""
    rows = labels.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = bounded(rows, "doc_id", most_rows).select(F.col("doc_id").alias("_id"), "label")
    # most_rows bounds this side
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    # a row an id: of several texts the one with the smallest MD5
    text = F.coalesce(F.col("text"), F.lit(""))
    found = found.groupBy("doc_id", "label").agg(F.min_by(text, F.md5(text)).alias("text"))
    found = found.select(F.col("doc_id").cast("bigint"), F.col("label").cast("int"), "text")
    table: pd.DataFrame = found.mapInArrow(_bags(buckets), "doc_id long, label int, ids binary, counts binary").toPandas()
    if table.empty:
        return Model(np.zeros(buckets, np.float32), 0.0)
    table = table.sort_values(["doc_id", "label"], kind="stable")
    bags = []
    for ids, counts in zip(table["ids"], table["counts"], strict=True):
        n = np.frombuffer(counts, np.float32)
        bags.append((np.frombuffer(ids, np.uint32), n / max(n.sum(), 1)))
    return descend(bags, table["label"].to_numpy(), buckets, size, epochs, rate, seed)


def score(model: Model, texts: list[str]) -> np.ndarray:
    """Probability of label 1 of each text."""
    total, n = np.zeros(len(texts)), np.zeros(len(texts))
    for bucket, owner in features(texts, len(model.weight)):
        total += np.bincount(owner, model.weight[bucket], len(texts))
        n += np.bincount(owner, minlength=len(texts))
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(n, 1) + model.bias, -500, 500)))


def scored(docs: DataFrame, model: Model, id_column: str = "doc_id") -> DataFrame:
    """One row per document: id and score. The model travels as a broadcast of fixed size."""
    kind = dict(docs.dtypes)[id_column]
    shared = docs.sparkSession.sparkContext.broadcast((model.weight, model.bias))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in in_pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score(Model(*shared.value), texts))], ["id", "score"])

    thin = docs.select(F.col(id_column).alias("id"), F.col("text").alias("text"))
    return thin.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_column)

"""Directly addressable codes, and files of token ids read back."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra import numpy as hnp
from tokenizers import Tokenizer

from tests.llm import helpers
from vanewatch.llm import tokenfiles
from vanewatch.llm.addressable import WIDEST, Codes, packed_bits, unpacked_bits, widths
from vanewatch.llm.queries import QUERIES, VOCABULARY
from vanewatch.session import fresh_dir


@settings(max_examples=100, deadline=None)
@given(hnp.arrays(np.uint32, st.integers(0, 1500), elements=st.sampled_from([0, 1, 7, 255, 256, 49407, 2**24, 2**32 - 1])), st.randoms())
def test_any_place_of_the_codes(values, random):
    codes = Codes.from_bytes(b"xyz" + Codes.of(values).to_bytes(), 3)
    assert codes.size == len(values) and (codes.take(np.arange(len(values))) == values).all()
    some = np.array([random.randrange(len(values)) for _ in range(20)] if len(values) else [], np.int64)
    assert (codes.take(some) == values[some]).all()


@settings(max_examples=100, deadline=None)
@given(hnp.arrays(np.uint32, st.integers(0, 1500), elements=st.sampled_from([0, 1, 7, 255, 256, 49407, 2**24, 2**32 - 1])), st.randoms())
def test_any_stretch_of_the_codes(values, random):
    codes = Codes.from_bytes(b"xyz" + Codes.of(values).to_bytes(), 3)
    for _ in range(10):
        start, end = sorted(random.randint(0, len(values)) for _ in range(2))
        assert (codes.between(start, end) == values[start:end]).all()
    assert (codes.between(0, len(values)) == values).all()


@pytest.mark.parametrize("width", range(1, WIDEST + 1))
def test_bits_lie_in_a_row(width):
    """Next to a plain string of bits, over more values than are packed at once."""
    values = np.random.default_rng(width).integers(0, 1 << width, (1 << 16) + 13).astype(np.uint32)
    bits = "".join(f"{v:0{width}b}" for v in values.tolist())
    bits += "0" * (-len(bits) % 8)
    data = packed_bits(values, width)
    assert data.tobytes() == int(bits, 2).to_bytes(len(bits) // 8, "big") + bytes(3)
    for start, end in ((0, len(values)), (3, 3), (5, 70), (65_530, 65_549), (len(values) - 1, len(values))):
        assert (unpacked_bits(data, width, start, end) == values[start:end]).all()


def test_whole_files_are_read_in_stretches(monkeypatch):
    """Reading all documents of a file asks for no single places, which cost several times as much."""
    rng = np.random.default_rng(3)
    rows = [(rng.random(n) ** 4 * 49_000).astype(np.uint32) for n in (1, 0, 700, 2, 300_000, 5, 9000)]
    shard = tokenfiles.Shard(tokenfiles.Shard.to_bytes(4, 2, [7, None, 8, 8, 9, 10, -3], rows) + b"\n")
    monkeypatch.setattr(Codes, "take", None)
    found = shard.documents().to_pydict()
    assert found["id"] == [7, None, 8, 8, 9, 10, -3] and found["n_tokens"] == [len(r) for r in rows]
    assert found["ids_crc32"] == [zlib.crc32(r.tobytes()) for r in rows]


def test_widths_are_the_cheapest():
    rng = np.random.default_rng(1)
    values = (rng.random(3000) ** 6 * 900).astype(np.uint32)

    def bits(plan):
        total, done = 0.0, 0
        for k, w in enumerate(plan):
            n = len(values) if k == 0 else int((values >> done > 0).sum())
            total += n * (w + (1 + 32 / 512 if k < len(plan) - 1 else 0))
            done += w
        return total

    def plans(left):
        yield [left]
        for w in range(1, left):
            yield from ([w, *rest] for rest in plans(left - w))

    assert bits(widths(values)) == min(map(bits, plans(10)))


def expected(rows, library, end=(2,)):
    """(id, start, n, crc) by the library alone; rows of (id, text)."""
    found, start = [], 0
    for i, ids in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        found.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


def encoded(docs, library):
    return [(r.doc_id, [*library.encode(r.text or "", add_special_tokens=False).ids, 2]) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("shard_tokens", [1, 700, 1 << 22])
def test_files_hold_every_document(spark, shard_tokens):
    library = Tokenizer.from_file(VOCABULARY)
    docs = helpers.awkward_documents(spark)
    folder = fresh_dir(spark, "tokens")
    tokenfiles.write(docs, VOCABULARY, folder, end_id=2, shard_tokens=shard_tokens)
    found = tokenfiles.documents(spark, folder).select("id", "start", "n_tokens", "ids_crc32").collect()
    wanted = encoded(docs, library)
    assert sorted(map(tuple, found)) == expected(wanted, library)

    ids = dict(wanted)
    asked = [(i, p) for i in (0, 11, 13, 18, 99) for p in (0, 1, 5, len(ids.get(i, ())) - 1, 10**6, -1)]
    answers = tokenfiles.tokens_at(spark, folder, spark.createDataFrame(asked, "id long, place int")).collect()
    assert {tuple(a) for a in answers} == {(i, p, ids[i][p]) for i, p in asked if i in ids and 0 <= p < len(ids[i])}


def test_repeated_and_nameless_rows(spark):
    """Of one id all rows stand together; null ids come last; the starts leave no gap."""
    library = Tokenizer.from_file(VOCABULARY)
    docs = helpers.with_repeats(helpers.awkward_documents(spark))
    twice = docs.where("doc_id = 3").withColumn("text", docs.text)
    other = docs.where("doc_id = 7").selectExpr("cast(3 as long) as doc_id", *docs.columns[1:])
    docs = docs.unionByName(twice).unionByName(other).repartition(5)
    folder = fresh_dir(spark, "tokens")
    tokenfiles.write(docs, VOCABULARY, folder)
    found = sorted(map(tuple, tokenfiles.documents(spark, folder).select("start", "n_tokens", "id", "ids_crc32").collect()))
    ends = [s + n for s, n, *_ in found]
    assert [s for s, *_ in found] == [0, *ends[:-1]]
    assert [i for _, _, i, _ in found] == sorted((i for _, _, i, _ in found), key=lambda i: (i is None, i or 0))
    wanted = [(i, n, c) for i, _, n, c in expected(encoded(docs, library), library)]
    assert sorted(((i is None, i or 0), n, c) for _, n, i, c in found) == sorted(((i is None, i or 0), n, c) for i, n, c in wanted)


def test_empty_table_and_broken_file(spark, tmp_path):
    folder = fresh_dir(spark, "tokens")
    tokenfiles.write(helpers.awkward_documents(spark).limit(0), VOCABULARY, folder)
    assert tokenfiles.documents(spark, folder).count() == 0
    whole = tokenfiles.Shard.to_bytes(0, 0, [1], [np.arange(9, dtype=np.uint32)]) + b"\n"
    assert tokenfiles.Shard(whole).codes.take(np.array([8, 2])).tolist() == [8, 2]
    with pytest.raises(ValueError):
        tokenfiles.Shard(whole[:-3] + b"\1\1\n")


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = QUERIES["op12_token_files"](spark, sf_dir).collect()
    library = Tokenizer.from_file(VOCABULARY)
    assert sorted(map(tuple, found)) == expected(encoded(docs, library), library)

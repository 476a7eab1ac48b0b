"""The registered queries and the pipeline on the smallest table."""

import sys
from collections import Counter

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from tests.llm import helpers
from vanewatch.llm import rules
from vanewatch.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_their_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.sql(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    got = QUERIES[name](spark, sf_dir)
    expected = con.sql(f"select {', '.join(got.columns)} from ({SQL[name]})").fetchall()
    assert Counter(map(tuple, got.collect())) == Counter(expected)


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_core_does_not_import_the_text_operators():
    core = [m for n, m in sys.modules.items() if n.startswith("vanewatch.") and not n.startswith("vanewatch.llm")]
    assert not any("vanewatch.llm" in (getattr(v, "__module__", None) or "") for m in core for v in vars(m).values())


def test_pipeline_stages(spark, sf_dir):
    """Each stage works on all that the one before kept, and what it decides takes effect."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    stage = dict(corpus_pipeline.STAGES)
    good = stage["quality_rules"](spark, docs, sf_dir).cache()
    verdicts = {r.doc_id for r in rules.quality_verdicts(docs).where("kept").collect()}
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == verdicts
    unique = stage["exact_dedup"](spark, good, sf_dir).cache()
    near = stage["near_dedup"](spark, unique, sf_dir).cache()
    left = {r.doc_id: r.text for r in unique.collect()}
    assert len({"".join(helpers.words(t)) for t in left.values()}) == len(left)
    roots = helpers.linked(left, 5, 80)
    assert {r.doc_id for r in near.collect()} == set(roots.values())
    mixed = stage["mixing"](spark, near, sf_dir)
    copies = Counter(r.doc_id for r in mixed.collect())
    assert set(copies.values()) <= {1, 2} and set(copies) <= set(roots.values())
    packed = stage["packing"](spark, mixed, sf_dir).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == copies
    assert set(copies) <= set(texts)


def test_stages_on_awkward_rows(spark, sf_dir):
    """Nulls in every column, repeated rows, clashing and further columns; then nothing at all."""
    rows = helpers.with_repeats(helpers.awkward_documents(spark)).cache()
    stage = dict(corpus_pipeline.STAGES)
    for name in ("quality_rules", "exact_dedup", "near_dedup", "mixing"):
        left = stage[name](spark, rows, sf_dir).cache()
        assert left.columns == rows.columns and set(map(repr, left.collect())) <= set(map(repr, rows.collect())), name
        if name != "mixing":
            assert left.count() <= rows.count()
    packed = stage["packing"](spark, rows, sf_dir).collect()
    assert sum(r.piece == 0 for r in packed) == rows.count()
    assert sorted((r.sequence_id, r.offset) for r in packed) == sorted({(r.sequence_id, r.offset) for r in packed})
    none = rows.limit(0)
    for _, run in corpus_pipeline.STAGES:
        assert run(spark, none, sf_dir).count() == 0

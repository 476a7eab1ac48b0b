"""Every registered query against its SQL twin, and the entry points."""

import importlib.util
import subprocess
import sys
from pathlib import Path

import pytest

from vanewatch.plans import catalog

ROOT = Path(__file__).resolve().parents[1]


def load(path):
    spec = importlib.util.spec_from_file_location(path.stem.strip("_"), path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


ENTRY = load(ROOT / "__spark_entry__.py")
CHECK = load(ROOT / "tools/check_queries.py")
WITHOUT_SQL = {"rul_regressor_metrics", "forest_confidence"}  # iterative fits


def test_all_but_the_fits_have_sql():
    assert set(catalog.QUERIES) - set(catalog.SQL) == WITHOUT_SQL
    assert set(catalog.SQL) <= set(catalog.QUERIES) <= set(ENTRY.queries())
    assert set(ENTRY.oracle_sql()) <= set(ENTRY.queries())


@pytest.mark.parametrize("absent", ["vanewatch.llm", "corpus_pipeline", "public_tokenizers"])
def test_entry_without_the_text_operators(absent):
    """Whatever part of them cannot be imported: the rest works."""
    code = f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    found = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    assert found.stdout.split() == [str(len(catalog.QUERIES)), str(len(catalog.SQL))]


def test_entry(spark):
    rows = ENTRY.entry(spark)
    assert rows.columns == ["engine", "remaining_cycles", "risk_level"] and rows.count() == 15


@pytest.mark.parametrize("name", sorted(ENTRY.queries()))
def test_query(spark, sf_dir, name):
    sql = ENTRY.oracle_sql().get(name)
    verdict = CHECK.compare(spark, CHECK.connect(sf_dir), ENTRY.queries()[name], sql, sf_dir)
    assert verdict.startswith("ok" if sql else "rows only"), verdict

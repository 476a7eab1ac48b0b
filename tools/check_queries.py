"""Run registered queries next to their SQL twins in DuckDB and compare all rows.

python tools/check_queries.py [sf_dir] [name ...]
"""

from __future__ import annotations

import importlib.util
import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from vanewatch.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def load_entry():
    path = ROOT / "__spark_entry__.py"
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return repr(round(value, 6) + 0.0)
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    names, got = table(df.columns, rows)
    if not sql:
        return f"rows only ({len(got)})"
    result = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in result.description}
    want_names, want = table([d[0] for d in result.description], result.fetchall())
    if names != want_names:
        return f"FAIL columns {names} != {want_names}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        lost = [r for r in want if r not in set(got)][:3]
        return f"FAIL rows {len(got)} vs {len(want)}; only Spark {extra}; only SQL {lost}"
    short = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    odd = {n: (short[n], kinds[n]) for n in short if (short[n] == "int") != (kinds[n] == "INTEGER")}
    return f"ok ({len(got)})" + (f" types {odd}" if odd else "") + ("" if got else " EMPTY")


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        "check",
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.sql.warehouse.dir": "/tmp/check-warehouse"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    entry = load_entry()
    oracle, failed = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            verdict = compare(spark, con, fn, oracle.get(name), sf_dir)
        except Exception as problem:  # report and go on with the next query
            verdict = f"FAIL {type(problem).__name__}: {str(problem)[:900]}"
            if wanted:
                traceback.print_exc()
        failed += verdict.startswith("FAIL")
        print(f"{name:28s} {time.time() - start:6.2f}s {verdict}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())

"""Compare each registered query with its DuckDB oracle, order-insensitively.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if hasattr(v, "item"):  # numpy scalar
        return _norm(v.item())
    if isinstance(v, int):
        return repr(float(v))
    return str(v)


def rows_of(columns: list[str], records) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is not None, x or "") for x in t))


def compare(spark, con, name: str, run, sql: str, sf_dir: str) -> tuple[bool, str]:
    t0 = time.time()
    sdf = run(spark, sf_dir)
    s_rows = sdf.collect()
    s_cols = sdf.columns
    t1 = time.time()
    con.execute(f"CREATE OR REPLACE VIEW oracle_view AS {sql}")  # the driver's check does so too
    rel = con.sql("FROM oracle_view")
    d_cols = rel.columns
    d_rows = rel.fetchall()
    msg = f"{name}: spark {len(s_rows)} rows {t1 - t0:.2f}s, duckdb {len(d_rows)} rows"
    if sorted(s_cols) != sorted(d_cols):
        return False, msg + f" COLUMNS differ {sorted(s_cols)} vs {sorted(d_cols)}"
    a = rows_of(s_cols, [tuple(r) for r in s_rows])
    b = rows_of(d_cols, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, msg + f" VALUES differ, e.g. {diff}"
    return True, msg + " OK"


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from propyield.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            n = qs[name](spark, sf_dir).count()
            print(f"{name}: rows-only, {n} rows")
            continue
        try:
            ok, msg = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # report and go on
            ok, msg = False, f"{name}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(msg, flush=True)
    print(f"{bad} mismatches")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

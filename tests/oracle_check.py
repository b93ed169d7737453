"""Run queries() against oracle_sql() on DuckDB, like the driver's correctness gate.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
                 "float": "FLOAT", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
                 "timestamp": "TIMESTAMP WITH TIME ZONE", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_mismatches(sdf, rel) -> list[str]:
    spark_types = dict(sdf.dtypes)
    out = []
    for col, dtype in zip(rel.columns, rel.types):
        want = SPARK_TO_DUCK.get(spark_types.get(col, "?"), spark_types.get(col, "?"))
        if str(dtype) != want:
            out.append(f"{col}: spark {spark_types.get(col)} vs duck {dtype}")
    return out


def compare(spark, con, sf_dir: str, name: str, fn, sql: str | None, sdf=None) -> tuple[bool, str]:
    t0 = time.time()
    if sdf is None:
        sdf = fn(spark, sf_dir)
    cols = sdf.columns
    rows = sdf.collect()
    t1 = time.time()
    if sql is None:
        return True, f"{len(rows)} rows (no oracle) {t1 - t0:.1f}s"
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    if sorted(cols) != sorted(dcols):
        return False, f"columns differ: spark={cols} duck={dcols}"
    bad_types = type_mismatches(sdf, rel)
    if bad_types:
        return False, f"types differ: {bad_types}"
    order = sorted(cols)
    si = [cols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    a = Counter(tuple(norm(r[i]) for i in si) for r in rows)
    b = Counter(tuple(norm(r[i]) for i in di) for r in drows)
    if a != b:
        only_a = list((a - b).elements())[:3]
        only_b = list((b - a).elements())[:3]
        return False, f"values differ ({len(rows)} vs {len(drows)} rows)\n  spark-only {only_a}\n  duck-only  {only_b}"
    return True, f"{len(rows)} rows {t1 - t0:.1f}s"


def main(argv: list[str]) -> int:
    from zoneflow.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = build_session()
    con = duck(sf_dir)
    qs, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        try:
            ok, msg = compare(spark, con, sf_dir, name, fn, oracles.get(name))
        except Exception as err:  # report and continue
            ok, msg = False, f"error: {type(err).__name__}: {str(err)[:400]}"
        bad += not ok
        print(f"{'PASS' if ok else 'FAIL'} {name}: {msg}", flush=True)
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

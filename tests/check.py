"""Run registered queries against their DuckDB SQL and report differences.

    python tests/check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tickerloom.sources.standins import BASE  # noqa: E402


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return repr(value + 0.0)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [cell(v) for v in value]
    if isinstance(value, bool):
        return value
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([cell(r[i]) for i in order] for r in rows), key=repr)


def open_duck(sf_dir: str):
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def compare(spark, con, name, run, sql, sf_dir):
    started = time.time()
    df = run(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    spark_sec = time.time() - started
    if sql is None:
        return True, f"rows-only {len(got)} rows  spark {spark_sec:.1f}s", got
    started = time.time()
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    want = rel.fetchall()
    duck_sec = time.time() - started
    info = f"{len(got)} rows  spark {spark_sec:.1f}s  duck {duck_sec:.1f}s"
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}", got
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a == b:
        return (len(got) > 0), info + ("" if got else "  EMPTY"), got
    if len(a) != len(b):
        info += f"  rows {len(a)} != {len(b)}"
    left, right = {repr(x) for x in a}, {repr(x) for x in b}
    info += f"\n   only spark: {[x[:600] for x in sorted(left - right)[:2]]}\n   only duck:  {[x[:600] for x in sorted(right - left)[:2]]}"
    return False, info, got


def main() -> int:
    import __spark_entry__ as spark_entry
    from tickerloom.session import local_session

    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args[:1] == ["--sf"]:
        sf_dir, args = args[1], args[2:]
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = open_duck(sf_dir)
    queries, checks = spark_entry.queries(), spark_entry.oracle_sql()
    names = [n for n in queries if not args or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in args)]
    bad = []
    for name in names:
        try:
            ok, info, _ = compare(spark, con, name, queries[name], checks.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001
            ok, info = False, f"{type(error).__name__}: {str(error)[:900]}"
        print("ok  " if ok else "FAIL", name, info, flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(names) - len(bad)}/{len(names)} ok; failing: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

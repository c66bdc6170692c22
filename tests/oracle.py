"""Run queries beside their SQL in DuckDB and report differences.

    python tests/oracle.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, int):
        return f"i{value}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return f"{type(value).__name__}:{value}"


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark, con, query, sql, sf):
    start = time.time()
    df = query(spark, sf)
    got_columns, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - start
    if sql is None:
        return None, f"{len(got)} rows", seconds
    cur = con.execute(sql)
    want_columns, want = canonical([d[0] for d in cur.description], cur.fetchall())
    if got_columns != want_columns:
        return False, f"columns {got_columns} != {want_columns}", seconds
    if got == want:
        return True, f"{len(got)} rows", seconds
    extra = [r for r in got if r not in set(want)][:3] if len(got) < 300000 else []
    lost = [r for r in want if r not in set(got)][:3] if len(got) < 300000 else []
    return False, f"{len(got)} rows, want {len(want)}; only ours {extra}; only theirs {lost}", seconds


def main() -> int:
    import __spark_entry__ as entry
    from labelworks.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con = local_session("oracle"), connect(args.sf)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args.names or queries:
        try:
            ok, note, seconds = compare(spark, con, queries[name], sql.get(name), args.sf)
        except Exception as error:
            ok, note, seconds = False, f"{type(error).__name__}: {str(error)[:600]}", 0.0
        bad += ok is False
        print(f"{'ok  ' if ok else 'rows' if ok is None else 'BAD '} {name:32s} {seconds:6.1f}s  {note}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)

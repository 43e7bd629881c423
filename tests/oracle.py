"""Compare registered queries with their SQL.  ``python tests/oracle.py [sf] [name prefix ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_module  # noqa: E402
from zonewise.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    """Same columns, same rows, same values?"""
    start = time.time()
    df = entry_module.queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    spark_s = time.time() - start
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        return False, f"{len(got)} rows, no SQL, {spark_s:.1f}s"
    start = time.time()
    result = con.sql(sql)
    names, want = result.columns, result.fetchall()
    note = f"{len(got)}/{len(want)} rows, {spark_s:.1f}s/{time.time() - start:.1f}s"
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {n: t for n, t in df.dtypes}
    a, b = _sorted(got, df.columns), _sorted(want, names)
    odd = {n for r in got for n, v in zip(df.columns, r) if isinstance(v, (Decimal, list, dict, tuple))}
    odd |= {n for r in want for n, v in zip(names, r) if isinstance(v, (Decimal, list, dict, tuple))}
    if odd:
        return False, f"{note} values that do not hash plainly: {sorted(odd)}"
    if a == b and [[type(v) for v in r] for r in a] == [[type(v) for v in r] for r in b]:
        return True, note
    differing = [(x, y) for x, y in zip(a, b) if x != y][:3]
    return False, f"{note} differ: {differing} {kinds}"


if __name__ == "__main__":
    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    prefixes = tuple(sys.argv[2:])
    folder = f"/root/testdata/sf{scale}"
    session, db = local_session(), connect(folder)
    bad = 0
    for query in entry_module.queries():
        if prefixes and not query.startswith(prefixes):
            continue
        try:
            ok, text = compare(session, db, folder, query)
        except Exception as error:  # report and go on with the next query
            ok, text = False, f"{type(error).__name__}: {str(error)[:700]}"
        bad += not ok
        print("ok  " if ok else "FAIL", query, text, flush=True)
    print("failures:", bad)

"""Run registered queries next to their SQL twins.

    python -m tests.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        return repr(round(float(v), 6) + 0.0)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def differences(spark, con, key, fn, sql, sf_dir) -> str | None:
    """None when both sides agree, else what differs."""
    df = fn(spark, sf_dir)
    names = df.columns
    got = rows_of(names, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    con.execute(f"create or replace view twin as {sql}")  # a twin must work as a view
    cur = con.execute("select * from twin")
    want_names = [d[0] for d in cur.description]
    if sorted(names) != sorted(want_names):
        return f"columns {sorted(names)} != {sorted(want_names)}"
    types = {n: t for n, t in df.dtypes}
    exact = {d[0]: str(d[1]) for d in cur.description}
    for n, t in types.items():
        pair = (t, exact[n])
        if pair not in {("bigint", "BIGINT"), ("double", "DOUBLE"), ("string", "VARCHAR")}:
            return f"types of {n}: {pair}"
    want = rows_of(want_names, cur.fetchall())
    if not want:
        return "twin has no rows"
    if got != want:
        only_got = [r for r in got if r not in set(want)][:3]
        only_want = [r for r in want if r not in set(got)][:3]
        return f"rows {len(got)} != {len(want)}; only spark {only_got}; only sql {only_want}; columns {sorted(names)}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from daytally.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark, con = local_session(8), duck(sf_dir)
    bad = 0
    for key, fn in entry.queries().items():
        if chosen and key not in chosen:
            continue
        start = time.time()
        try:
            diff = differences(spark, con, key, fn, entry.oracle_sql().get(key), sf_dir)
        except Exception as e:  # report and go on with the next query
            diff = f"{type(e).__name__}: {str(e)[:600]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'DIFF'} {key} {time.time() - start:.2f}s {diff or ''}", flush=True)
    print("differing:", bad)

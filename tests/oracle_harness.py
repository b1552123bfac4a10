"""Local stand-in for the driver's correctness gate: run a registered
Spark query and its DuckDB SQL on the same tables and compare row count,
column names and an order-free multiset of rounded values.

    python tests/oracle_harness.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(sorted((k, norm(x)) for k, x in v.asDict().items()))
    return v


def rows_key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if sql is None:
        return ("rows-only", len(s_rows), None, t1 - t0)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return ("COLS", s_cols, d_cols, t1 - t0)
    if len(s_rows) != len(d_rows):
        return ("COUNT", len(s_rows), len(d_rows), t1 - t0)
    a, b = rows_key(s_cols, s_rows), rows_key(d_cols, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return ("VALUES", diff, None, t1 - t0)
    return ("ok", len(s_rows), None, t1 - t0)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    prefixes = [a for a in argv[1:] if not a.startswith("/")]
    from quarry.session import build_session
    import __spark_entry__ as E
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in sorted(qs.items()):
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        try:
            status = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # report and go on
            status = ("ERROR", repr(e)[:600], None, 0)
        if status[0] not in ("ok", "rows-only"):
            bad += 1
        print(f"{name:40s} {status[0]:9s} {status[1]!s:.300} {status[2] if status[2] is not None else ''!s:.300}"
              f" {status[3]:.2f}s", flush=True)
    print(f"mismatches: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

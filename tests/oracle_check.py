"""Compare every registered Spark query with its DuckDB oracle.

Usage: python tests/oracle_check.py [sf_dir] [name-substring ...]
Prints one line per query: status, rows (spark/oracle), seconds.
Comparison: column names, row count, and the sorted multiset of rows
(numbers rounded to 6 places and then compared exactly, arrays as given).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, bool):
        return int(v)
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


def coarse(v):
    """Sort key that is insensitive to last-digit float differences."""
    if isinstance(v, float):
        return round(v, 3)
    if isinstance(v, tuple):
        return tuple(coarse(x) for x in v)
    return v


def rows_key(rows):
    return sorted((tuple(norm(x) for x in r) for r in rows), key=lambda r: (repr(coarse(r)), repr(r)))


def close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(close(x, y) for x, y in zip(a, b))
    return a == b


def duck_connect(sf_dir):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, build, sql, sf_dir):
    t0 = time.time()
    df = build(spark, sf_dir)
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if sql is None:
        return "NO-SQL", len(srows), None, t1 - t0
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    if sorted(cols) != sorted(ocols):
        return f"COLS {sorted(cols)} vs {sorted(ocols)}", len(srows), len(orows), t1 - t0
    idx = [ocols.index(c) for c in cols]
    orows = [tuple(r[i] for i in idx) for r in orows]
    if len(srows) != len(orows):
        return "ROWCOUNT", len(srows), len(orows), t1 - t0
    a, b = rows_key(srows), rows_key(orows)
    for x, y in zip(a, b):
        if not close(x, y):
            return f"VALUES e.g. {x} vs {y}", len(srows), len(orows), t1 - t0
    return "OK", len(srows), len(orows), t1 - t0


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    from probity.session import get_session
    import __spark_entry__ as e
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck_connect(sf_dir)
    qs, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for name, build in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        try:
            status, ns, no, secs = compare(spark, con, name, build, sqls.get(name), sf_dir)
        except Exception as ex:  # report and continue
            status, ns, no, secs = f"ERROR {type(ex).__name__}: {str(ex)[:300]}", None, None, 0
        if status not in ("OK", "NO-SQL"):
            bad += 1
        print(f"{status[:400]:<12} {name:<36} spark={ns} oracle={no} {secs:.2f}s", flush=True)
    print(f"bad={bad}")
    spark.stop()


if __name__ == "__main__":
    main()

"""Run registered queries in Spark and their SQL in DuckDB, and compare whole results.

    python tests/oracle.py [sf_dir] [query ...]
"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tableferry.plans.oracle import ORACLE, TABLES  # noqa: E402
from tableferry.plans.queries import QUERIES  # noqa: E402


def connection(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0)
                                                          for v in r))


def expected(con, name):
    cur = con.execute(ORACLE[name])
    return canonical([d[0] for d in cur.description], cur.fetchall())


def actual(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def kinds(names, rows):
    return {n: sorted({type(r[i]).__name__ for r in rows if r[i] is not None})
            for i, n in enumerate(names)}


def difference(got, want):
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if kinds(*got) != kinds(*want):
        return f"types {kinds(*got)} != {kinds(*want)}"
    if got[1] == want[1]:
        return None
    a, b = set(got[1]), set(want[1])
    return (f"rows {len(got[1])} != {len(want[1])}; only here {list(a - b)[:3]};"
            f" only in SQL {list(b - a)[:3]}")


if __name__ == "__main__":
    from tableferry.session import local_session

    args = sys.argv[1:]
    sf = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    con = connection(sf)
    failed = []
    for q in args or QUERIES:
        t0 = time.time()
        try:
            got = actual(session, sf, q)
            t1 = time.time()
            diff = difference(got, expected(con, q)) if q in ORACLE else "no SQL"
            print(f"{'ok ' if diff is None else 'BAD'} {q:26} rows {len(got[1]):7}"
                  f" spark {t1 - t0:6.2f} sql {time.time() - t1:6.2f} {diff or ''}", flush=True)
        except Exception as e:  # noqa: BLE001
            diff = str(e)
            print(f"ERR {q:26} {type(e).__name__} {diff[:1500]}", flush=True)
        if diff and diff != "no SQL":
            failed.append(q)
    print("failed:", failed)

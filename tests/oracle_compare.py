"""Compare each queries() entry with its oracle_sql() entry through DuckDB.

Usage: python -m tests.oracle_compare [sf_dir] [key ...]
Checks row count, column names and an order-insensitive value digest
(doubles rounded to 9 significant digits).
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.9g}"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, keys=None, verbose=True):
    import __spark_entry__ as E
    qs, oracles = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for key in keys or list(qs):
        t0 = time.time()
        df = qs[key](spark, sf_dir)
        cols = df.columns
        rows = [tuple(r) for r in df.collect()]
        secs = time.time() - t0
        res = {"rows": len(rows), "secs": round(secs, 2)}
        if key in oracles:
            cur = con.execute(oracles[key])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
            h1, l1 = digest(cols, rows)
            h2, l2 = digest(ocols, orows)
            res.update(oracle_rows=len(orows), cols_match=sorted(cols) == sorted(ocols),
                       hash_match=h1 == h2)
            if verbose and not (res["cols_match"] and h1 == h2):
                print(key, "cols", sorted(cols), sorted(ocols))
                a, b = set(l1), set(l2)
                print("  spark-only", sorted(a - b)[:5])
                print("  oracle-only", sorted(b - a)[:5])
        results[key] = res
        if verbose:
            print(key, res, flush=True)
    return results


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from stratus.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    out = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in out.items() if v.get("hash_match") is False or v.get("cols_match") is False]
    print("MISMATCH:", bad)

"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Comparison: row count, column names, and an order-insensitive hash of the
rows with columns sorted by name (floats rounded to 9 digits).

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    return str(v)


def digest(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256()
    for line in lines:
        h.update(line.encode())
        h.update(b"\n")
    return h.hexdigest(), lines


def duck_connection(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as entry

    queries = entry.queries()
    oracle = entry.oracle_sql()
    con = duck_connection(sf_dir)
    results = {}
    for name in names or sorted(queries):
        t0 = time.time()
        try:
            df = queries[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK-ERROR", str(e).splitlines()[0][:300])
            if verbose:
                print(f"{name:32s} SPARK-ERROR {results[name][1]}")
            continue
        ts = time.time() - t0
        if name not in oracle:
            results[name] = ("ROWS-ONLY", len(srows))
            if verbose:
                print(f"{name:32s} rows-only  rows={len(srows)}  {ts:.1f}s")
            continue
        try:
            cur = con.execute(oracle[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("DUCK-ERROR", str(e).splitlines()[0][:300])
            if verbose:
                print(f"{name:32s} DUCK-ERROR {results[name][1]}")
            continue
        hs, ls = digest(scols, srows)
        hd, ld = digest(dcols, drows)
        ok = (sorted(scols) == sorted(dcols)) and len(srows) == len(drows) and hs == hd
        results[name] = ("OK" if ok else "MISMATCH", len(srows), len(drows))
        if verbose:
            print(f"{name:32s} {'OK' if ok else 'MISMATCH':9s} rows={len(srows)}/{len(drows)}  {ts:.1f}s")
            if not ok:
                if sorted(scols) != sorted(dcols):
                    print("   cols spark:", sorted(scols), "\n   cols duck: ", sorted(dcols))
                a, b = set(ls), set(ld)
                for x in sorted(a - b)[:3]:
                    print("   spark-only:", x[:300])
                for x in sorted(b - a)[:3]:
                    print("   duck-only: ", x[:300])
    return results


if __name__ == "__main__":
    from netsift.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "ROWS-ONLY")]
    print("FAILED:", bad if bad else "none")

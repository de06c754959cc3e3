"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: python tests/oracle_compare.py [sf_dir] [name-substring ...]
Prints one line per query: OK / MISMATCH / ERROR with details.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v  # strict: both engines round identically, so raw values must match
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_hash(cols, rows):
    order = sorted(range(len(cols)), key=lambda j: cols[j])
    keyed = sorted(repr(tuple(_norm(r[j]) for j in order)) for r in rows)
    return hashlib.md5("\n".join(keyed).encode()).hexdigest(), keyed


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    ts = time.time() - t0
    if sql is None:
        return "ROWS", f"{len(srows)} rows, spark {ts:.1f}s"
    t0 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    td = time.time() - t0
    if sorted(scols) != sorted(dcols):
        return "MISMATCH", f"columns spark={sorted(scols)} duck={sorted(dcols)}"
    if len(srows) != len(drows):
        return "MISMATCH", f"rows spark={len(srows)} duck={len(drows)}"
    hs, ks = rows_hash(scols, srows)
    hd, kd = rows_hash(dcols, drows)
    if hs != hd:
        diff = [(a, b) for a, b in zip(ks, kd) if a != b]
        return "MISMATCH", f"{len(diff)} differing rows, e.g. {diff[:2]}"
    return "OK", f"{len(srows)} rows, spark {ts:.1f}s duck {td:.1f}s"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as entry
    from tidecast.session import get_session
    spark = get_session()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        try:
            status, msg = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            status, msg = "ERROR", f"{type(e).__name__}: {str(e)[:400]}"
        bad += status in ("MISMATCH", "ERROR")
        print(f"{status:8s} {name}: {msg}", flush=True)
    print(f"done, {bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

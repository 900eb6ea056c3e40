"""Spark-vs-DuckDB comparison used by the tests and by hand:

    python tests/compare.py /root/testdata/sf0.01 [key ...]

Row count, column names and an order-insensitive hash of the values.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def digest(columns, rows) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]
    return len(rows), sorted(columns), h


def compare(spark, sf_dir: str, keys=None, con=None, verbose=True):
    import __spark_entry__ as entry

    qs, sql = entry.queries(), entry.oracle_sql()
    con = con or duck(sf_dir)
    results = {}
    for k in keys or list(qs):
        t = time.time()
        df = qs[k](spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        s = digest(df.columns, srows)
        ts = time.time() - t
        if k in sql:
            t = time.time()
            rel = con.sql(sql[k])
            o = digest(rel.columns, rel.fetchall())
            to = time.time() - t
            ok = s == o
        else:
            o, to, ok = None, 0.0, None
        results[k] = (ok, s, o)
        if verbose:
            print(f"{k:34s} {'OK ' if ok else ('-- ' if ok is None else 'BAD')} spark={s[0]} rows {ts:.2f}s"
                  f" oracle={o[0] if o else '-'} rows {to:.2f}s" + ("" if ok in (True, None) else f"\n   {s}\n   {o}"))
    return results


if __name__ == "__main__":
    from citeweave.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, extra={"spark.ui.showConsoleProgress": "false"})
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] is False]
    print("mismatches:", bad)

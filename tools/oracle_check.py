"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [key ...]
Prints one line per key: rows, schema and value matches.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, (dt.datetime,)):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, key, entry, sf_dir):
    t0 = time.time()
    sdf = entry.build(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = {"key": key, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if not entry.sql:
        res["check"] = "rows-only"
        return res
    cur = con.execute(entry.sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    res.update(duck_rows=len(drows), duck_sec=round(time.time() - t1, 2))
    res["schema"] = sorted(scols) == sorted(dcols)
    if not res["schema"]:
        res["cols"] = (sorted(scols), sorted(dcols))
    # logical types: Spark simple type vs DuckDB column type
    dtypes = {d[0]: str(d[1]).upper() for d in cur.description}
    want = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
            "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT"}
    bad_types = {c: (t, dtypes.get(c)) for c, t in sdf.dtypes
                 if c in dtypes and want.get(t, t.upper()) != dtypes[c]}
    if bad_types:
        res["types"] = bad_types
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    res["values"] = a == b
    if not res["values"]:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["first_diff"] = diff
    return res


def main(argv):
    from ratelens.plans.registry import load_all
    from ratelens.session import build_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:]
    spark = build_session()
    con = duck(sf_dir)
    entries = load_all()
    bad = 0
    sql_only = "--sql-only" in keys
    keys = [k for k in keys if not k.startswith("--")]
    for k, e in entries.items():
        if keys and k not in keys:
            continue
        if sql_only and not e.sql:
            continue
        try:
            r = compare(spark, con, k, e, sf_dir)
        except Exception as ex:  # report and go on
            r = {"key": k, "error": f"{type(ex).__name__}: {str(ex)[:400]}"}
        ok = r.get("check") == "rows-only" or (r.get("schema") and r.get("values") and "types" not in r)
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"done: {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)

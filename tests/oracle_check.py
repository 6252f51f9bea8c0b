"""Run a registered query in Spark and its oracle SQL in DuckDB, and compare.

Mirrors the driver's check: same column names, same row count, same
multiset of rows (columns sorted by name, rows order-insensitive).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, key: str, sf_dir: str, con=None, verbose: bool = True) -> dict:
    from inkline.plans.queries import ORACLE, QUERIES
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = QUERIES[key](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if key not in ORACLE:
        res["status"] = "no-oracle"
        return res
    cur = con.execute(ORACLE[key])
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res["duck_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"COLUMNS spark={sorted(s_cols)} duck={sorted(d_cols)}"
        return res
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a == b:
        res["status"] = "match"
    else:
        res["status"] = "MISMATCH"
        sa, sb = set(a), set(b)
        only_s = [r for r in a if r not in sb][:2]
        only_d = [r for r in b if r not in sa][:2]
        res["example_spark_only"] = [str(r)[:600] for r in only_s]
        res["example_duck_only"] = [str(r)[:600] for r in only_d]
        res["columns"] = sorted(s_cols)
    return res


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    from inkline.session import get_spark
    from inkline.plans.queries import QUERIES
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or list(QUERIES)
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, k, sf_dir, con)
        except Exception as exc:  # report and continue
            r = {"key": k, "status": f"ERROR {type(exc).__name__}: {str(exc)[:400]}"}
        if r["status"] not in ("match", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))

"""Run Spark queries next to their DuckDB checks: python tests/oracle_check.py [sf] [name-part ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

import duckdb

DATA = "/root/testdata"


def duck(sf_dir: str):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        n = f.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


def oracle_rows(con, sql: str):
    rel = con.sql(sql)
    cols = list(rel.columns)
    return cols, [str(t) for t in rel.types], rel.fetchall()


def normal(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(repr(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name, fn, sql):
    df = fn(spark, sf_dir)
    got_cols, got = normal(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return "rows-only", len(got), ""
    cols, types, rows = oracle_rows(con, sql)
    want_cols, want = normal(cols, rows)
    if got_cols != want_cols:
        return "COLUMNS", len(got), f"{got_cols} vs {want_cols}"
    if got != want:
        g, w = set(got), set(want)
        return (
            "DIFF", len(got),
            f"spark={len(got)} duck={len(want)}\n   only spark: {sorted(g - w)[:3]}\n   only duck:  {sorted(w - g)[:3]}\n   {got_cols} {types}",
        )
    return "ok", len(got), ""


def main():
    import __spark_entry__ as e
    from touchgrid.session import build

    args = sys.argv[1:]
    sf = args[0] if args else "sf0.01"
    parts = args[1:]
    sf_dir = f"{DATA}/{sf}"
    spark = build(cores="8", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, os_ = e.queries(), e.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if parts and not any(p in name for p in parts):
            continue
        t = time.time()
        try:
            status, n, msg = compare(spark, con, sf_dir, name, fn, os_.get(name))
        except Exception as ex:
            status, n, msg = "ERROR", 0, str(ex)[:1500]
        flag = "" if status in ("ok", "rows-only") and n else " <<<"
        bad += bool(flag)
        print(f"{name:48s} {status:9s} rows={n:<7d} {time.time() - t:6.2f}s{flag} {msg}", flush=True)
    print("BAD", bad)


if __name__ == "__main__":
    main()

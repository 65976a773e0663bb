"""Run the catalog in Spark and DuckDB and compare the results row by row."""

from __future__ import annotations

import datetime as dt
import math
import time
from collections import Counter
from decimal import Decimal

import duckdb

from catalog.oracle import ORACLE
from catalog.queries import QUERIES

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return Counter(tuple(plain(r[k]) for k in order) for r in rows)


def kinds(rows, width):
    found = [set() for _ in range(width)]
    for r in rows:
        for k, v in enumerate(r):
            if v is not None:
                found[k].add(type(v).__name__)
    return found


def compare(spark, con, name: str, sf_dir: str) -> str:
    """Empty text when equal, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    mine = [tuple(r) for r in df.collect()]
    cursor = con.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    theirs = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    a_kinds = dict(zip(df.columns, kinds(mine, len(columns))))
    b_kinds = dict(zip(columns, kinds(theirs, len(columns))))
    bad = {c: (a_kinds[c], b_kinds[c]) for c in columns if a_kinds[c] != b_kinds[c]}
    if bad:
        return f"types {bad}"
    a, b = rows_of(df.columns, mine), rows_of(columns, theirs)
    if a != b:
        only_a, only_b = sorted((a - b).elements(), key=str), sorted((b - a).elements(), key=str)
        return f"{len(only_a)} rows differ, e.g. {only_a[:2]} against {only_b[:2]} ({sorted(columns)})"
    return ""


def main(argv):
    from stowage.session import build_session

    sf_dir, only = argv[1], argv[2:]
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    failed = 0
    for name in QUERIES:
        if only and name not in only:
            continue
        start = time.time()
        try:
            verdict = compare(spark, con, name, sf_dir) if name in ORACLE else "no oracle"
        except Exception as e:  # report and go on with the next query
            verdict = f"ERROR {str(e)[:600]}"
        failed += bool(verdict)
        print(f"{name:30s} {time.time() - start:6.2f}s {verdict or 'equal'}", flush=True)
    print(f"{dt.datetime.now():%H:%M} {failed} failed")


if __name__ == "__main__":
    import sys

    main(sys.argv)

"""Run registered queries next to their SQL twins in DuckDB and compare values.

usage: python tools/check.py [sf] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _norm(value):
    if isinstance(value, float) and not math.isnan(value):
        return repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_norm(row[i]) for i in order) for row in rows)


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(df, con, sql):
    """'' when equal, else what differs."""
    ours_cols, ours = rows_of(df.columns, df.collect())
    if sql is None:
        return "" if ours is not None else "none"
    result = con.execute(sql)
    theirs_cols, theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if ours_cols != theirs_cols:
        return f"columns {ours_cols} != {theirs_cols}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(bad)} differ: {ours_cols} {bad[0]}" if bad else ""


def main():
    from riskloom.plans import registry
    from riskloom.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(registry.QUERIES)
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = []
    for name in names:
        start = time.time()
        try:
            df = registry.QUERIES[name](spark, sf_dir)
            message = compare(df, con, registry.ORACLE.get(name))
        except Exception as error:  # noqa: BLE001
            message = f"{type(error).__name__}: {str(error)[:600]}"
        kind = "sql" if name in registry.ORACLE else "rows"
        print(f"{'ok  ' if not message else 'FAIL'} {name} [{kind}] {time.time() - start:.1f}s {message}", flush=True)
        if message:
            failed.append(name)
    print(f"{len(names) - len(failed)}/{len(names)} ok; failed: {failed}")
    spark.stop()
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())

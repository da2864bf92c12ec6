"""Run registered queries beside their SQL twins in DuckDB and compare the rows.

Usage: python tests/check_oracles.py [sf_dir] [name ...]

With PLAIN=1 the session has Spark's defaults (200 shuffle partitions).
"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(value):
    if value is None:
        return ("0none", "")
    if isinstance(value, float):
        if math.isnan(value):
            return ("0none", "")
        return ("num", f"{value:.9g}" if value != 0 else "0")
    if isinstance(value, bool):
        return ("bool", str(value))
    if isinstance(value, int):
        return ("num", f"{value:.9g}" if abs(value) < 1e9 else str(value))
    return ("str", str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(canonical(r[i]) for i in order) for r in rows])


def compare(spark, con, sf_dir, name, fn, sql):
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(got), "rows only" if got else "NO ROWS"
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = rows_of(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return len(got), f"COLUMNS {sorted(df.columns)} vs {sorted(columns)}"
    if got == want:
        return len(got), "match"
    diff = [(a, b) for a, b in zip(got, want) if a != b][:2]
    return len(got), f"DIFF rows {len(got)} vs {len(want)}; {diff}"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as entry
    from traceframe.session import local_session

    if os.environ.get("PLAIN"):
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.driver.memory", "12g").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = local_session("oracles")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    bad = 0
    for name in names:
        start = time.time()
        try:
            n, outcome = compare(spark, con, sf_dir, name, queries[name], oracles.get(name))
        except Exception as e:  # noqa: BLE001
            n, outcome = 0, f"ERROR {type(e).__name__}: {str(e)[:600]}"
        bad += outcome not in ("match", "rows only")
        print(f"{time.time() - start:6.2f}s {name}: {n} rows, {outcome}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())

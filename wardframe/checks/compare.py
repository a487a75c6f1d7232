"""Run registered queries beside their SQL in DuckDB and report differences.

    python -m wardframe.checks.compare <parquet folder> [query name part ...]
"""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

from pyspark.sql import SparkSession


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def difference(df, con, sql: str) -> str | None:
    """None if both give the same columns and rows, else what differs first."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    want = _sorted_rows(names, expected.fetchall())
    got = _sorted_rows(df.columns, df.collect())
    if len(want) != len(got):
        return f"{len(got)} rows instead of {len(want)}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return f"{sorted(names)}: {g} instead of {w}"
    return None


def main(sf_dir: str, *parts: str) -> int:
    from wardframe.checks.all_queries import ORACLES, QUERIES

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb_connection(sf_dir)
    failed = 0
    for key, job in QUERIES.items():
        if parts and not any(p in key for p in parts):
            continue
        start = time.time()
        try:
            df = job(spark, sf_dir)
            problem = difference(df, con, ORACLES[key]) if key in ORACLES else None
            n = df.count() if problem is None and not parts else ""
        except Exception as e:  # report and go on
            problem, n = f"{type(e).__name__}: {str(e)[:600]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {time.time() - start:6.1f}s {key} {n} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))

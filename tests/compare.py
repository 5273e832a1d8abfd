"""Run the registered queries beside their SQL in DuckDB.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normal(value):
    if isinstance(value, float):
        return float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr)


def check(spark, connection, name, build, sql, sf_dir):
    """Difference between both results as text, empty if there is none."""
    frame = build(spark, sf_dir)
    got = rows_of(frame.columns, frame.collect())
    cursor = connection.execute(sql)
    columns = [c[0] for c in cursor.description]
    want = rows_of(columns, cursor.fetchall())
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    if not want:
        return "the oracle has no rows"
    if got != want:
        pairs = [(g, w) for g, w in zip(got, want) if g != w][:2]
        return f"{len(got)} rows, oracle {len(want)}: {pairs}"
    kinds = [{type(v) for row in rows for v in row} for rows in (got, want)]
    return "" if kinds[0] == kinds[1] else f"value types differ: {kinds}"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from conftest import session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, connection = session(), oracle(folder)
    chosen = sys.argv[2:] or list(entry.oracle_sql())
    failed = 0
    for key in chosen:
        start = time.time()
        try:
            problem = check(spark, connection, key, entry.queries()[key], entry.oracle_sql()[key], folder)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        failed += bool(problem)
        print(f"{key:26s} {time.time() - start:6.2f}s {'ok' if not problem else problem}", flush=True)
    print("failed:", failed)

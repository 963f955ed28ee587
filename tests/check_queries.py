"""Runs queries against their SQL twins: ``python tests/check_queries.py [sf_dir] [name ...]``."""

from __future__ import annotations

import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 9)
    return value


def rows(columns, data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in data), key=repr)


def compare(spark, connection, name: str, sf_dir: str) -> str | None:
    """None when the query equals its SQL twin, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    left = rows(df.columns, df.collect())
    result = connection.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    right = rows(names, result.fetchall())
    if [tuple(map(repr, r)) for r in left] == [tuple(map(repr, r)) for r in right]:
        return None
    only_left = [r for r in left if r not in set(right)][:3]
    only_right = [r for r in right if r not in set(left)][:3]
    return f"{len(left)} vs {len(right)} rows\n  spark {only_left}\n  sql   {only_right}"


if __name__ == "__main__":
    from feedmetrics.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    chosen = sys.argv[2:] or list(entry.oracle_sql())
    session = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    duck, failed = connect(sf), []
    for query_name in chosen:
        start = time.time()
        try:
            problem = compare(session, duck, query_name, sf)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {query_name} {time.time() - start:.1f}s"
              + (f"\n  {problem}" if problem else ""), flush=True)
        if problem:
            failed.append(query_name)
    print(f"{len(chosen) - len(failed)}/{len(chosen)} ok; failed: {failed}")

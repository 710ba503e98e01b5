"""Run registered queries beside their SQL and compare the rows: ``python tests/compare.py [sf] [names...]``."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def differences(ours: DataFrame, con: duckdb.DuckDBPyConnection, name: str) -> str | None:
    """A short account of what differs from the rows of the SQL, or None."""
    columns = sorted(ours.columns)
    theirs = con.execute(contract.oracle_sql()[name])
    their_columns = [d[0] for d in theirs.description]
    if sorted(their_columns) != columns:
        return f"columns {columns} against {sorted(their_columns)}"
    place = [their_columns.index(c) for c in columns]
    right = Counter(tuple(row[i] for i in place) for row in theirs.fetchall())
    left = Counter(tuple(row[c] for c in columns) for row in ours.collect())
    if left == right:
        kinds = {type(v).__name__ for row in left for v in row}, {type(v).__name__ for row in right for v in row}
        return None if kinds[0] == kinds[1] else f"value types {kinds}"
    extra, missing = list((left - right).items())[:3], list((right - left).items())[:3]
    return f"{sum(left.values())} rows against {sum(right.values())}; {columns}\n  ours only {extra}\n  theirs only {missing}"


if __name__ == "__main__":
    sf = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    # Queries that SQL cannot express have tests of their own.
    wanted = sys.argv[2:] or list(contract.oracle_sql())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", os.environ.get("SESSION_ZONE", "UTC"))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for name in wanted:
        start = time.time()
        try:
            verdict = differences(contract.queries()[name](spark, sf), con, name) or "same"
        except Exception as exc:  # noqa: BLE001
            verdict = f"failed: {type(exc).__name__}: {str(exc)[:1500]}"
        print(f"{name:22s} {time.time() - start:6.1f}s {verdict}", flush=True)

"""Run queries against their SQL in DuckDB: python tests/check_queries.py [sf_dir] [name ...]"""

from __future__ import annotations

import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
import pandas as pd

import __spark_entry__ as entry
from tidemark.session import build_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].astype(object)
    df = df.where(df.notna(), None)
    rows = sorted((tuple(_plain(v) for v in row) for row in df.itertuples(index=False)), key=repr)
    return rows


def _plain(value):
    if value is None or value is pd.NaT:
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return float(value)
    return str(value)


def compare(spark, connection, name: str, sf_dir: str) -> str | None:
    """None when rows and columns agree, else a description."""
    found = entry.queries()[name](spark, sf_dir).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if len(found) else "no rows"
    wanted = connection.execute(sql).df()
    if sorted(found.columns) != sorted(wanted.columns):
        return f"columns {sorted(found.columns)} vs {sorted(wanted.columns)}"
    mine, theirs = canonical(found), canonical(wanted)
    if mine != theirs:
        extra = [r for r in mine if r not in set(theirs)][:3]
        lacking = [r for r in theirs if r not in set(mine)][:3]
        return f"{len(mine)} vs {len(theirs)} rows; extra {extra}; missing {lacking}"
    return None


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in names:
        started = time.time()
        try:
            problem = compare(spark, connection, name, sf_dir)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - started:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")

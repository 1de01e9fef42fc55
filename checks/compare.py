"""Run queries and their SQL side by side: python -m checks.compare [folder] [query ...]"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = []
    for row in frame.itertuples(index=False, name=None):
        rows.append(tuple(_cell(v) for v in row))
    return sorted(rows, key=repr)


def _cell(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
        return None
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).tz_localize(None).isoformat()
    if isinstance(value, float):
        return value
    return value.item() if hasattr(value, "item") else value


def differences(spark, folder: str, name: str) -> str | None:
    """What differs between a query and its SQL; None when nothing does."""
    result = QUERIES[name](spark, folder).toPandas()
    if name not in ORACLES:
        return None if len(result) else "no rows"
    wanted = connect(folder).execute(ORACLES[name]).df()
    if sorted(result.columns) != sorted(wanted.columns):
        return f"columns {sorted(result.columns)} / {sorted(wanted.columns)}"
    got, want = _plain(result), _plain(wanted)
    if len(got) != len(want):
        return f"{len(got)} rows / {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    from newsloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("compare", 8)
    spark.sparkContext.setLogLevel("ERROR")
    for query in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            found = differences(spark, folder, query)
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{query:24} {time.time() - start:6.2f}s {'ok' if found is None else found}", flush=True)

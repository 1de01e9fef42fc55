from __future__ import annotations

import tempfile

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from newsloom.streaming.incremental import first_arrivals, first_per_window, late_rows, once_per_key, read_first

START = 28_000_000  # minutes since 1970
SCHEMA = "id long, site string, at timestamp, note string"


@pytest.fixture
def stream(spark):
    """Delivers rows (id, site, minute, note) and runs a stream over what is new; each run starts from the checkpoint."""
    base = tempfile.mkdtemp(prefix="stream-")

    def deliver(start, *rows):
        frame = spark.createDataFrame(list(rows), "id long, site string, minute long, note string")
        made = frame.select("id", "site", F.timestamp_seconds((F.col("minute") + START) * 60).alias("at"), "note")
        made.coalesce(1).write.mode("append").parquet(f"{base}/in")
        query = start(spark.readStream.schema(SCHEMA).parquet(f"{base}/in"), f"{base}/out", f"{base}/progress")
        query.awaitTermination()
        return query

    deliver.out, deliver.source = f"{base}/out", f"{base}/in"
    return deliver


def _minutes(df, *columns):
    return tuples(df.select(*columns, (F.unix_timestamp("at") / 60 - START).cast("long").alias("minute")))


def _windows(s, out, progress):
    return first_per_window(s, out, progress, ("site",), "at", "10 minutes", "20 minutes")


def _once(s, out, progress):
    return once_per_key(s, out, progress, ("id",), "at", "20 minutes")


def test_a_window_is_written_once_it_is_over(spark, stream):
    stream(_windows, (1, "a", 5, "x"), (2, "a", 3, "z"), (3, "a", 3, "y"), (4, "b", 12, "x"))
    assert spark.read.parquet(stream.out).count() == 0  # rows may still be 20 minutes late
    stream(_windows, (5, "a", 2, "in time"), (6, "a", 31, "x"))
    assert _minutes(spark.read.parquet(stream.out), "id", "site", "note") == [(5, "a", "in time", 2)]
    query = stream(_windows, (7, "a", 1, "late"), (8, "b", 200, "x"))
    assert late_rows(query) == 1
    got = _minutes(spark.read.parquet(stream.out), "id", "site", "note")
    assert got == [(4, "b", "x", 12), (5, "a", "in time", 2), (6, "a", "x", 31)]


def test_closed_windows_equal_those_without_state(spark, stream):
    import random

    rng = random.Random(2)
    for base in (0, 30, 60, 90, 500):
        rows = [(base * 10 + i, rng.choice("abc"), base + rng.randint(0, 9 if base == 500 else 35), rng.choice("xyz")) for i in range(40)]
        stream(_windows, *rows)
    both = tempfile.mkdtemp(prefix="plain-")
    source = spark.readStream.schema(SCHEMA).parquet(stream.source)
    first_arrivals(source, f"{both}/out", f"{both}/progress", ("site",), "at", "10 minutes").awaitTermination()
    want = read_first(spark, f"{both}/out", ("site",)).where(f"at < timestamp_seconds({480 + START} * 60)")
    columns = ("site", "window", "at", "id", "note")
    assert tuples(spark.read.parquet(stream.out), *columns) == tuples(want, *columns)


def test_state_is_bounded_by_the_delay(spark, stream):
    kept = []
    for n in range(5):
        query = stream(_once, *[(100 * n + i, "a", 100 * n + i, None) for i in range(50)])
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert kept[-1] == kept[1] <= 50 and spark.read.parquet(stream.out).count() == 250


def test_copies_and_late_rows_of_keys(spark, stream):
    stream(_once, (1, "a", 0, "first"), (2, "a", 15, "x"), (2, "a", 15, "x"))
    stream(_once, (1, "a", 0, "again"), (3, "a", 16, "new"))
    query = stream(_once, (4, "a", 100, "x"))
    assert late_rows(query) == 0
    query = stream(_once, (5, "a", 20, "late"), (2, "a", 15, "late copy"), (6, "a", 90, "in time"))
    assert late_rows(query) == 2
    got = _minutes(spark.read.parquet(stream.out), "id", "note")
    assert got == [(1, "first", 0), (2, "x", 15), (3, "new", 16), (4, "x", 100), (6, "in time", 90)]

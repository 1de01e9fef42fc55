from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import tuples
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.functions import text
from newsloom.functions.dates import leading_date, month_key, month_start, utc_date
from newsloom.functions.stopwords import ENGLISH
from newsloom.operators.cleaning import clean, conform, deduplicate, normalize, union_doc_types
from newsloom.sources.readers import read_rows


def _one(spark, value, expression):
    frame = spark.createDataFrame([(value,)], "v string")
    return frame.select(expression(F.col("v"))).first()[0]


def test_stop_words_are_those_of_spark(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert ENGLISH == StopWordsRemover.loadDefaultStopWords("english")


def test_clean_summary_keeps_inner_spaces_and_tabs(spark):
    assert _one(spark, "  Two\nLines  HERE\t ", text.clean_summary) == "two lines  here\t"
    assert _one(spark, None, text.clean_summary) is None


_pieces = st.text(alphabet=' \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 　aÉ"\'b', max_size=30)


@settings(max_examples=15, deadline=None)
@given(st.lists(_pieces, min_size=1, max_size=40))
def test_white_space_as_in_python(spark, values):
    frame = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    got = frame.select(
        "i", text.squeeze(F.col("v")).alias("s"), text.strip(F.col("v")).alias("t")
    ).collect()
    for row in got:
        assert row["s"] == " ".join(values[row["i"]].split())
        assert row["t"] == values[row["i"]].strip()


def test_title_and_quotes(spark):
    assert _one(spark, " a\r\nb\n", text.one_line) == "a  b"
    assert _one(spark, 'say "hi"', text.quiet_quotes) == "say 'hi'"


def test_url_host(spark):
    assert _one(spark, "https://a.example/x/y", text.url_host) == "a.example"
    assert _one(spark, "no host", text.url_host) is None
    assert _one(spark, None, text.url_host) is None


def test_utc_dates_do_not_depend_on_the_session_zone(spark):
    values = {
        "2024-01-01": dt.date(2024, 1, 1),
        "2024-01-01T23:30:00Z": dt.date(2024, 1, 1),
        "2024-01-01T23:30:00.123Z": dt.date(2024, 1, 1),
        "2024-01-01T23:30:00-05:00": dt.date(2024, 1, 2),
        "2024-01-01 00:30:00+02:00": dt.date(2023, 12, 31),
        "2024-01-01T23:30:00": dt.date(2024, 1, 1),
        "soon": None,
        "": None,
    }
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            day = utc_date(F.col("v"), frame.schema["v"].dataType).cast("string")
            got = {r[0]: r[1] for r in frame.select("v", day).collect()}
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == {k: v and v.isoformat() for k, v in values.items()}


def test_leading_date_ignores_what_follows(spark):
    assert _one(spark, "2024-03-05T10:00:00Z", leading_date) == dt.date(2024, 3, 5)
    assert _one(spark, "not a date", leading_date) is None


def test_month_key(spark):
    assert _one(spark, "2031-12-31", lambda c: month_key(c.cast("date"))) == "2031-12"


def test_months_of_instants_are_months_of_utc(spark):
    from pyspark.sql.types import TimestampType

    try:
        for zone in ("America/Los_Angeles", "Asia/Tokyo", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            at = F.lit("2025-02-01T03:00:00Z").cast("timestamp")
            early = F.lit("2025-01-31T23:00:00Z").cast("timestamp")
            row = spark.range(1).select(
                month_key(at, TimestampType()), month_key(early, TimestampType()), month_start(at, TimestampType()).cast("string")
            )
            assert tuple(row.first()) == ("2025-02", "2025-01", "2025-02-01 00:00:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_normalize_fills_defaults(spark):
    raw = spark.createDataFrame(
        [("7", " T\nx ", None, " a  b \"c\" ", None), ("x", None, "true", None, '[{"a":1}]')],
        "id string, title string, featured string, summary string, launches string",
    ).withColumns(
        {c: F.lit(None).cast("string") for c in ("url", "image_url", "news_site", "published_at", "updated_at", "events")}
    )
    first, second = normalize(raw).orderBy("title", ascending=False).collect()
    assert (first["id"], first["title"], first["summary"], first["featured"]) == (7, "T x", "a b 'c'", False)
    assert first["launches"] == "[]" and first["url"] == ""
    assert second["id"] is None and second["featured"] is True and second["launches"] == '[{"a":1}]'
    assert normalize(raw, missing_id=0).where("id = 0").count() == 1
    assert normalize(raw).columns == schemas.RAW.fieldNames()


def test_union_casts_and_marks(spark, rows):
    docs = read_rows(spark, rows)
    text_ids = docs.withColumn("id", F.col("id").cast("string")).select(*reversed(docs.columns))
    union = union_doc_types({"articles": docs, "blogs": text_ids})
    assert tuples(union, "doc_type", "id") == [
        (t, i) for t in ("articles", "blogs") for i in (41, 42, 7)
    ]
    assert conform(union, schemas.RAW).schema == schemas.RAW


def test_deduplicate_keeps_the_latest_and_is_idempotent(spark):
    frame = spark.createDataFrame(
        [(1, "2024-01-01", "b"), (1, "2024-01-03", "z"), (1, "2024-01-03", "a"), (2, None, "x"), (2, "2023-01-01", "y")],
        "id int, updated_at string, title string",
    )
    once = deduplicate(frame)
    assert tuples(once) == [(1, "2024-01-03", "a"), (2, "2023-01-01", "y")]
    assert tuples(deduplicate(once)) == tuples(once)


def test_deduplicate_by_type_and_id(spark, rows):
    docs = read_rows(spark, rows)
    union = union_doc_types({"articles": docs, "blogs": docs})
    cleaned = clean(union)
    assert deduplicate(cleaned).count() == 3
    assert deduplicate(cleaned, ["doc_type", "id"]).count() == 6


def _copies(share):
    """Rows of which about ``share`` are copies of one key, and some keys with a null or a few copies."""
    rng = random.Random(1)
    data = [(7 if rng.random() < share else i, rng.choice([None, *range(50)]), i) for i in range(3000)]
    data += [(None, rng.randrange(9), 10_000 + i) for i in range(20)]
    data += [(i, rng.randrange(9), 20_000 + i) for i in range(0, 3000, 100)]
    best = {}
    for key, at, n in data:
        rank = (-1 if at is None else at, -n)
        best[key] = max(best.get(key, rank), rank)
    expected = sorted(((k, None if a < 0 else a, -n) for k, (a, n) in best.items()), key=repr)
    return data, expected


@pytest.mark.parametrize("share", [0.0, 0.05, 0.33, 0.7])
def test_deduplicate_with_a_hot_key(spark, share):
    data, expected = _copies(share)
    frame = spark.createDataFrame(data, "id int, updated_at int, n int").repartition(6)
    result = deduplicate(frame)
    assert tuples(result) == expected
    plan = result._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("WindowGroupLimit", plan.index("WindowGroupLimit") + 1)
    assert plan.index("Exchange hashpartitioning(id") < partial
    assert "LeftAnti" in plan  # rows without copies are not shuffled


def test_deduplicate_nothing_and_no_copies(spark):
    frame = spark.createDataFrame([(1, 1, 1), (2, 1, 1)], "id int, updated_at int, n int")
    assert tuples(deduplicate(frame)) == tuples(frame)
    assert deduplicate(frame.where("false")).count() == 0
    assert deduplicate(spark.createDataFrame([], frame.schema)).count() == 0


def test_deduplicate_many_copied_keys(spark, monkeypatch):
    from newsloom.operators import joins

    data, expected = _copies(0.05)
    frame = spark.createDataFrame(data, "id int, updated_at int, n int")
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    result = deduplicate(frame)
    assert tuples(result) == expected

"""Shapes of physical plans that matter for large inputs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from newsloom.operators.facts import merge_documents
from newsloom.operators.profiles import source_reliability
from newsloom.operators.words import word_counts
from newsloom.sources.readers import read_parquet, since


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_merge_shuffles_each_side_once(spark, no_broadcast):
    docs = spark.range(100).select("id", F.lit("2024-01-01").cast("date").alias("published_at"))
    sides = [
        spark.range(100).select("id", F.lit(1).alias(column))
        for column in ("source_name", "topic_id", "sentiment_score")
    ]
    merged = merge_documents(docs, *sides)
    assert plan(merged).count("Exchange hashpartitioning(id") == 4


def test_date_bound_reaches_the_scan(spark):
    events = read_parquet(spark, "/root/testdata/sf0.001/events.parquet").select("event_id", "ts")
    text = plan(since(events, "2024-01-15", "ts"))
    assert "GreaterThanOrEqual(ts" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_counts_read_their_columns_only_and_combine_early(spark):
    docs = read_parquet(spark, "/root/testdata/sf0.001/documents.parquet")
    text = plan(word_counts(docs, "text"))
    assert "ReadSchema: struct<text:string>" in text
    assert text.index("functions=[count(1)]") < text.index("functions=[partial_count(1)]")
    assert text.index("Exchange hashpartitioning(filtered_words") < text.index("functions=[partial_count(1)]")


def test_shares_need_no_single_task(spark):
    docs = read_parquet(spark, "/root/testdata/sf0.001/documents.parquet")
    shares = source_reliability(docs.withColumn("url", F.lit("http://a/b")), "doc_id", "source")
    assert "Window" not in plan(shares)
    main = plan(shares).split("Subquery")[0]
    assert "Exchange SinglePartition" not in main

from __future__ import annotations

import re
import tempfile

import pytest
from conftest import tuples

from newsloom.operators.facts import attach_entities, merge_documents
from newsloom.sources.bucketed import read_bucketed, write_bucketed
from newsloom.sources.files import children

SIDES = {
    "dates": "id long, published_at date", "sources": "id long, source_name string",
    "topics": "id long, topic_id int", "sentiment": "id long, sentiment_score float",
}


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="buckets-")


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def _sides(spark):
    ids = spark.range(500)
    return {
        "dates": ids.selectExpr("id", "date_add(date '2031-01-01', cast(id % 9 as int)) as published_at"),
        "sources": ids.where("id % 2 = 0").selectExpr("id", "concat('s', id % 7) as source_name"),
        "topics": ids.where("id % 3 = 0").selectExpr("id", "cast(id % 5 as int) as topic_id"),
        "sentiment": ids.where("id % 5 > 0").selectExpr("id", "cast(id as float) as sentiment_score"),
    }


def _exchanges(df):
    df.collect()
    return re.findall(r"\b(?:Broadcast|Shuffle)?Exchange\b", df._jdf.queryExecution().executedPlan().toString())


def test_facts_are_put_together_without_a_shuffle(spark, folder, no_broadcast):
    sides = _sides(spark)
    want = tuples(merge_documents(*sides.values()))
    written = [write_bucketed(df, f"{folder}/{name}", "id", 6) for name, df in sides.items()]
    got = merge_documents(*written)
    assert _exchanges(got) == [] and tuples(got) == want
    assert _exchanges(merge_documents(*sides.values()))  # what there is without buckets
    entities = spark.range(0, 500, 4).selectExpr("id", "'x' as entities")
    both = attach_entities(got, write_bucketed(entities, f"{folder}/entities", "id", 6))
    assert _exchanges(both) == [] and both.where("entities is not null").count() == 125


def test_another_session_reads_the_buckets(spark, folder, no_broadcast):
    for name, df in _sides(spark).items():
        write_bucketed(df, f"{folder}/{name}", "id", 6)
    assert len([f for f in children(spark, f"{folder}/dates") if f.endswith(".parquet")]) <= 6
    other = spark.newSession()
    read = [
        read_bucketed(other, f"{folder}/{name}", other.createDataFrame([], types).schema, "id", 6)
        for name, types in SIDES.items()
    ]
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    got = merge_documents(*read)
    assert _exchanges(got) == [] and tuples(got) == tuples(merge_documents(*_sides(spark).values()))
    assert other.catalog.listTables() == []


def test_empty_side_and_null_ids(spark, folder):
    docs = spark.createDataFrame([(None, None), (1, None), (1, None)], SIDES["dates"])
    none = write_bucketed(spark.createDataFrame([], SIDES["sources"]), f"{folder}/sources", "id", 3)
    got = merge_documents(write_bucketed(docs, f"{folder}/dates", "id", 3), none)
    assert tuples(got) == [(1, None, None, None, None)] * 2 + [(None,) * 5]

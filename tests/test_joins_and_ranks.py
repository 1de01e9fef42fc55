from __future__ import annotations

import random

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from newsloom.operators import joins, ranking
from newsloom.operators.joins import hot_keys, lookup_join, measured_bytes, salted_join, small_enough


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(3)
    keys = ["hot"] * 400 + [None] * 200 + [f"k{rng.randrange(60)}" for _ in range(600)]
    return spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "n int, k string").repartition(5)


@pytest.fixture(scope="module")
def names(spark):
    listed = [("hot", 1.0), (None, 9.0)] + [(f"k{i}", float(i)) for i in range(0, 50)]
    return spark.createDataFrame(listed, "k string, v double")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_equals_plain_join(facts, names, how, null_safe):
    other = names.withColumnRenamed("k", "r")
    same = facts["k"].eqNullSafe(other["r"]) if null_safe else facts["k"] == other["r"]
    plain = facts.join(other, same, how)
    plain = plain.drop("r") if how in ("inner", "left") else plain
    columns = plain.columns
    assert tuples(salted_join(facts, names, ["k"], how, null_safe, rows=80), *columns) == tuples(plain)
    assert tuples(lookup_join(facts, names, ["k"], how, null_safe), *columns) == tuples(plain)
    assert tuples(lookup_join(facts, names, ["k"], how, null_safe, limit=0), *columns) == tuples(plain)


def test_join_of_keys_alone(facts, names):
    keys = facts.select("k")
    expected = sorted(tuples(keys.join(names, "k")))
    assert sorted(tuples(salted_join(keys, names, ["k"], "inner"))) == expected


def test_hot_keys_are_few_and_right(facts):
    assert tuples(hot_keys(facts, ["k"], 150)) == [("hot", 3), (None, 2)]
    assert tuples(hot_keys(facts, ["k"], 399)) == [("hot", 2)]
    assert hot_keys(facts, ["k"]).count() == 0
    assert joins.HOT_SHARE * 100_000 == 1


def test_hot_key_is_spread(facts, names):
    spread = salted_join(facts, names, ["k"], "inner", rows=50)
    parts = spread.where("k = 'hot'").select(F.spark_partition_id()).distinct().count()
    assert parts > 1 or spread.rdd.getNumPartitions() == 1


def test_measured_bytes_grow_with_the_text(spark):
    short = spark.createDataFrame([("ab", [1])], "s string, a array<int>")
    long = spark.createDataFrame([("ab" * 500, [1])], "s string, a array<int>")
    assert measured_bytes(long) - measured_bytes(short) == 998
    assert measured_bytes(short.where("false")) == 0
    assert small_enough(long) and not small_enough(long, 100)


def test_small_side_is_broadcast_and_large_side_is_not(facts, names):
    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(lookup_join(facts, names, ["k"]))
    beyond = plan(lookup_join(facts, names, ["k"], limit=10))
    assert beyond.count("strategy=broadcast") == 2  # the hot keys, once per side


@pytest.mark.parametrize(("aggregated", "one_task"), [(True, 10**6), (True, 3), (False, 10**6)])
def test_rank_with_ties_and_nulls(spark, aggregated, one_task, monkeypatch):
    monkeypatch.setattr(ranking, "ONE_TASK_ROWS", one_task)
    rng = random.Random(5)
    data = [
        (i, rng.choice(["a", "b", None]), rng.choice([1] * 20 + list(range(30))), rng.choice([None, 0.5, 1.5, 2.5]))
        for i in range(800)
    ]
    frame = spark.createDataFrame(data, "i int, g string, n int, x double").repartition(6)
    order = [("n", "desc"), ("x", "desc_nulls_first")]
    for group in ([], ["g"]):
        got = {r["i"]: r["rank"] for r in ranking.ranked(frame, order, group, aggregated=aggregated).collect()}

        def key(row):
            return (-row[2], 0 if row[3] is None else 1, -(row[3] or 0))

        for row in data:
            ahead = [o for o in data if (not group or o[1] == row[1]) and key(o) < key(row)]
            assert got[row[0]] == len(ahead) + 1


def test_pages_cut_the_sorted_rows(spark):
    frame = spark.range(95).select((F.col("id") * 37 % 95).alias("k"), F.lit("x").alias("other")).repartition(7)
    seen = []
    for number in range(1, 12):
        seen += [r["k"] for r in ranking.page(frame, [("k", "asc")], number, 10).collect()]
    assert seen == list(range(95))


def test_pages_of_two_columns_with_nulls(spark):
    rng = random.Random(2)
    data = [(rng.choice([None, 1, 2, 3]), i) for i in range(60)]
    frame = spark.createDataFrame(data, "a int, b int").repartition(5)
    order = [("a", "desc_nulls_first"), ("b", "asc")]
    wanted = sorted(data, key=lambda r: (r[0] is not None, -(r[0] or 0), r[1]))
    for number in range(1, 8):
        assert [tuple(r) for r in ranking.page(frame, order, number, 9).collect()] == wanted[9 * number - 9 : 9 * number]


def test_a_page_takes_no_large_sort(spark):
    frame = spark.range(1000).select(F.col("id").alias("k"), F.lit("y").alias("other"))
    far = ranking.page(frame, [("k", "asc")], 90, 10)
    text = far._jdf.queryExecution().executedPlan().toString()
    assert [r["k"] for r in far.collect()] == list(range(890, 900))
    assert "limit=" not in text and "LeftSemi" in text and "k" in text and ">= 890" in text

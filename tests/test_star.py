from __future__ import annotations

import datetime as dt
import tempfile

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.operators import constraints, merging
from newsloom.operators.facts import attach_entities, importance, merge_documents
from newsloom.plans.rankings import influential_sources, monthly_trends
from newsloom.sources import star


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="star-")


def _scored(spark, *rows):
    """article, source, topic, day, sentiment, importance"""
    values = [(a, s, t, d and dt.date.fromisoformat(d), x, y) for a, s, t, d, x, y in rows]
    return spark.createDataFrame(
        values,
        "article_id long, source_name string, topic_id int, published_at date, sentiment_score double, importance_score double",
    )


def _sources(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.SOURCE)


def _topics(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.TOPIC)


def _facts(spark, root):
    return tuples(
        star.read_facts(spark, root),
        "article_id",
        "source_id",
        "topic_id",
        F.col("published_at").cast("string"),
        "sentiment_score",
        "importance_score",
        "month",
    )


def test_load_two_batches(spark, root):
    topics = _topics(spark, (0, "moon, mars", "moon"))
    star.load_batch(
        spark,
        root,
        _scored(spark, (1, "b", 0, "2024-12-31", 0.5, 1.0), (2, "a", 0, "2025-01-01", None, None)),
        _sources(spark, ("b", "b.example", 0.5), ("a", "a.example", 0.5)),
        topics,
    )
    assert tuples(star.read_sources(spark, root)) == [(1, "a", "a.example", 0.5), (2, "b", "b.example", 0.5)]
    first = _facts(spark, root)
    assert first == [(1, 2, 0, "2024-12-31", 0.5, 1.0, "2024-12"), (2, 1, 0, "2025-01-01", None, None, "2025-01")]

    second = (
        _scored(
            spark,
            (2, "b", 1, "2025-01-01", 0.1, 0.2),  # known: scores change, source and topic stay
            (2, "b", 1, "2025-02-01", 0.3, 0.4),  # another day: a new fact
            (3, "new", 1, "2025-01-07", 0.0, 0.0),
            (4, "unknown", 0, "2025-01-07", 0.0, 0.0),
            (5, "a", None, "2025-01-07", 0.0, 0.0),
            (6, "a", 99, "2025-01-07", 0.0, 0.0),
            (7, "a", 0, None, 0.0, 0.0),
            (None, "a", 0, "2025-01-07", 0.0, 0.0),
        ),
        _sources(spark, ("b", "other.example", 0.9), ("new", "n.example", 0.1), ("bad", "x", 1.5), ("nohost", None, 0.1)),
        _topics(spark, (0, "changed", "changed"), (1, "stars", "stars")),
    )
    for _ in range(2):  # loading it again changes nothing
        refused = star.load_batch(spark, root, *second)
        assert tuples(star.read_sources(spark, root)) == [
            (1, "a", "a.example", 0.5), (2, "b", "b.example", 0.9), (3, "new", "n.example", 0.1),
        ]
        assert tuples(star.read_topics(spark, root)) == [(0, "moon, mars", "moon"), (1, "stars", "stars")]
        assert _facts(spark, root) == [
            (1, 2, 0, "2024-12-31", 0.5, 1.0, "2024-12"),
            (2, 1, 0, "2025-01-01", 0.1, 0.2, "2025-01"),
            (2, 2, 1, "2025-02-01", 0.3, 0.4, "2025-02"),
            (3, 3, 1, "2025-01-07", 0.0, 0.0, "2025-01"),
        ]
        assert sorted(tuples(refused["sources"], "source_name")) == [("bad",), ("nohost",)]
        assert tuples(refused["facts"], "article_id") == [(4,), (5,), (6,), (7,), (None,)]


def test_only_touched_months_are_rewritten(spark, root):
    from newsloom.sources.files import children

    sources, topics = _sources(spark, ("a", "a.example", 1.0)), _topics(spark, (0, "n", "c"))
    star.load_batch(spark, root, _scored(spark, (1, "a", 0, "2025-01-01", 0.0, 0.0)), sources, topics)
    before = children(spark, f"{root}/fact_article/version=1/month=2025-01")
    star.load_batch(spark, root, _scored(spark, (2, "a", 0, "2031-02-01", 0.0, 0.0)), sources, topics)
    assert children(spark, f"{root}/fact_article/version=1/month=2025-01") == before
    assert children(spark, f"{root}/fact_article") == ["version=1", "version=2"]
    star.load_batch(spark, root, _scored(spark, (3, "a", 0, "2025-01-08", 0.0, 0.0)), sources, topics)
    assert children(spark, f"{root}/fact_article") == ["version=2", "version=3"]  # what is replaced goes
    assert star.read_facts(spark, root).count() == 3
    assert len(children(spark, f"{root}/dim_source")) == 1


def test_only_touched_buckets_are_rewritten(spark, root):
    def batch(ids, score):
        frame = ids.selectExpr("id as article_id", "'a' as source_name", "0 as topic_id")
        dated = frame.withColumn("published_at", F.expr("date_add(date '2031-05-01', cast(pmod(article_id, 31) as int))"))
        return dated.withColumn("sentiment_score", F.lit(score)).withColumn("importance_score", F.lit(0.0))

    sources, topics = _sources(spark, ("a", "x", 1.0)), _topics(spark, (0, "n", "c"))

    def load(ids, score):
        star.load_batch(spark, root, batch(ids, score), sources, topics, bucket_rows=50)
        return star._listed(spark, root)

    first = load(spark.range(-500, 1500), 0.0)
    assert 30 <= len(first) <= 64 and {month for month, _ in first} == {"2031-05"}
    second = load(spark.range(700, 720), 0.5)  # 1 percent of the month's keys
    assert second.keys() == first.keys() and 1 <= sum(v == 2 for v in second.values()) <= 3
    assert star.read_facts(spark, root).where("sentiment_score = 0.5").count() == 20
    third = load(spark.range(1500, 1900), 1.0)  # new ids: the last bucket grows and is cut
    changed = {b for b, v in third.items() if v == 3}
    assert len(changed) >= 4 and all(low >= max(second)[1] for _, low in changed)
    facts = star.read_facts(spark, root)
    assert facts.count() == facts.select("article_id").distinct().count() == 2400
    assert tuples(facts.groupBy("sentiment_score").count()) == [(0.0, 1980), (0.5, 20), (1.0, 400)]
    sizes = star._read_buckets(spark, root, third).groupBy("low").count()
    assert sizes.where("count > 100").count() == 0
    again = load(spark.range(1500, 1900), 1.0)  # the same load again: the same buckets
    assert again.keys() == third.keys() and star.read_facts(spark, root).count() == 2400


def test_sums_equal_a_recount_after_load_reload_and_delete(spark, root):
    from newsloom.plans.rankings import influential_sources_of_sums, monthly_trends_of_sums

    sources = _sources(spark, *[(f"s{i}", "x", 0.5) for i in range(4)])
    topics = _topics(spark, *[(i, f"n{i % 2}", "c") for i in range(3)])

    def batch(low, high, score):
        days = [f"2031-0{i % 3 + 1}-0{i % 9 + 1}" for i in range(low, high)]
        return _scored(spark, *[(i, f"s{i % 4}", i % 3, d, 0.0, score if i % 5 else None) for i, d in zip(range(low, high), days)])

    def check():
        facts, sums = star.read_facts(spark, root), star.read_sums(spark, root)
        named = star.read_sources(spark, root), star.read_topics(spark, root)
        want = tuples(facts.groupBy("month", "source_id", "topic_id").agg(
            F.count("*").alias("rows"), F.count("article_id").alias("articles"),
            F.sum("importance_score").alias("score_sum"), F.count("importance_score").alias("scores"),
        ))
        assert tuples(sums) == want and want
        assert tuples(influential_sources_of_sums(sums, named[0])) == tuples(influential_sources(facts, named[0]))
        assert tuples(monthly_trends_of_sums(sums, named[1])) == tuples(monthly_trends(facts, named[1]))

    for low, high, score in ((0, 60, 1.0), (30, 90, 2.5), (30, 90, 2.5)):
        star.load_batch(spark, root, batch(low, high, score), sources, topics, bucket_rows=8)
        check()
    star.delete_sources(spark, root, spark.createDataFrame([("s1",)], "name string"))
    check()
    star.delete_topics(spark, root, spark.createDataFrame([(2,)], "topic_id int"))
    check()
    assert star.read_sums(spark, root).agg(F.sum("rows")).first()[0] == star.read_facts(spark, root).count()


def test_a_month_is_cut_into_many_buckets_in_one_round(spark, root, monkeypatch):
    """Facts are written on the way as they come and once more as they are cut, not once a level of the cuts."""
    labels, spool = [], star.spool

    def counted(df, label="spool"):
        labels.append(label)
        return spool(df, label)

    monkeypatch.setattr(star, "spool", counted)
    sources, topics = _sources(spark, ("a", "x", 1.0)), _topics(spark, (0, "n", "c"))

    def load(low, high):
        ids = spark.range(low, high).selectExpr("id as article_id", "'a' as source_name", "0 as topic_id", "date '2031-05-01' as published_at")
        scored = ids.withColumns({"sentiment_score": F.lit(0.0), "importance_score": F.lit(1.0)})
        labels.clear()
        star.load_batch(spark, root, scored, sources, topics, bucket_rows=10)

    load(0, 5000)
    assert labels.count("facts") == 1 and labels.count("placed") == 0 and labels.count("to-write") == 2
    sizes = star._read_buckets(spark, root, star._listed(spark, root)).groupBy("low").count()
    assert sizes.count() >= 250 and sizes.where("count > 20").isEmpty()
    load(4000, 5010)  # lands in the buckets that hold its ids
    facts = star.read_facts(spark, root)
    assert facts.count() == facts.select("article_id").distinct().count() == 5010


def test_cuts_of_several_levels_find_the_place_of_each_id(spark, root, monkeypatch):
    monkeypatch.setattr(star, "_CUTS", 3)
    monkeypatch.setattr(star, "_PARTS", 9)
    lows = [star._LEAST, *range(-50, 450, 5)]
    listed = spark.createDataFrame([("2031-05", low, 1, 0, 1) for low in lows], star._BUCKETS)
    facts = spark.range(-70, 500).selectExpr("id as article_id", "'2031-05' as month")
    odd = spark.createDataFrame([(None, "2031-05"), (3, "2031-06"), (4, None)], "article_id long, month string")
    placed = {(r["article_id"], r["month"]): r["low"] for r in star._in_buckets(facts.unionByName(odd), listed).collect()}
    assert placed.pop((None, "2031-05")) == placed.pop((3, "2031-06")) == placed.pop((4, None)) == star._LEAST
    assert placed == {(i, "2031-05"): max(low for low in lows if low <= i) for i in range(-70, 500)}


def test_days_of_one_article_are_not_cut(spark, root):
    sources, topics = _sources(spark, ("a", "x", 1.0)), _topics(spark, (0, "n", "c"))
    scored = _scored(spark, *[(7, "a", 0, f"2031-05-{d:02d}", 0.0, 0.0) for d in range(1, 31)])
    star.load_batch(spark, root, scored, sources, topics, bucket_rows=3)
    assert star.read_facts(spark, root).count() == 30 and len(star._listed(spark, root)) <= 2


def test_a_load_that_broke_off_changes_nothing(spark, root, monkeypatch):
    from newsloom.sources.files import children

    sources, topics = _sources(spark, ("a", "x", 1.0)), _topics(spark, (0, "n", "c"))
    star.load_batch(spark, root, _scored(spark, (1, "a", 0, "2025-01-01", 0.0, 0.0)), sources, topics)
    write = star._write_copy

    def broken(df, path):
        if path.endswith("fact_months"):
            raise OSError("lost")
        write(df, path)

    with monkeypatch.context() as patch:
        patch.setattr(star, "_write_copy", broken)
        with pytest.raises(OSError):
            star.load_batch(spark, root, _scored(spark, (2, "a", 0, "2025-01-09", 0.0, 0.0)), sources, topics)
        with pytest.raises(OSError):
            star.delete_topics(spark, root, spark.createDataFrame([(0,)], "topic_id int"))
    assert [f[0] for f in _facts(spark, root)] == [1]
    star.load_batch(spark, root, _scored(spark, (3, "a", 0, "2025-02-01", 0.0, 0.0)), sources, topics)
    assert [f[0] for f in _facts(spark, root)] == [1, 3]
    assert len(children(spark, f"{root}/fact_article")) == 2


def test_topics_without_a_name_are_refused(spark, root):
    topics = _topics(spark, (0, "n", "c"), (1, None, "c"), (2, "n", None), (None, "n", "c"))
    refused = star.load_batch(spark, root, _scored(spark, (1, "a", 0, "2025-01-01", 0.0, 0.0)), _sources(spark, ("a", "x", 1.0)), topics)
    assert tuples(star.read_topics(spark, root)) == [(0, "n", "c")]
    assert refused["topics"].count() == 3


def test_sql_over_the_tables(spark, root):
    scored = _scored(spark, (1, "a", 0, "2025-01-01", 0.0, 2.0), (2, "b", 0, "2025-01-02", 0.0, 4.0))
    sources = _sources(spark, ("a", "x", 0.5), ("b", "y", 0.5))
    star.load_batch(spark, root, scored, sources, _topics(spark, (0, "n", "c")))
    star.register_views(spark, root)
    rows = spark.sql("""
        SELECT s.name, RANK() OVER (ORDER BY AVG(f.importance_score) DESC) AS place
        FROM fact_article f JOIN dim_news_source s ON f.source_id = s.source_id JOIN dim_topic t ON f.topic_id = t.topic_id
        WHERE f.month = '2025-01' GROUP BY s.name
    """)
    assert tuples(rows) == [("a", 2), ("b", 1)]


def test_months_prune_folders(spark, root):
    sources, topics = _sources(spark, ("a", "a.example", 1.0)), _topics(spark, (0, "n", "c"))
    scored = _scored(spark, (1, "a", 0, "2025-01-01", 0.0, 0.0), (2, "a", 0, "2025-03-01", 0.0, 0.0))
    star.load_batch(spark, root, scored, sources, topics)
    one = star.read_facts(spark, root).where("month = '2025-03'")
    assert "PartitionFilters: [isnotnull(month" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1


def test_deleting_removes_the_facts(spark, root):
    scored = _scored(
        spark, (1, "a", 0, "2025-01-01", 0.0, 0.0), (2, "b", 0, "2025-01-02", 0.0, 0.0), (3, "a", 1, "2025-02-01", 0.0, 0.0),
        (4, "b", 1, "2025-03-01", 0.0, 0.0),
    )
    star.load_batch(
        spark, root, scored, _sources(spark, ("a", "x", 0.5), ("b", "y", 0.5)), _topics(spark, (0, "n", "c"), (1, "m", "d"))
    )
    star.delete_sources(spark, root, spark.createDataFrame([("a",), ("nobody",)], "name string"))
    assert [f[0] for f in _facts(spark, root)] == [2, 4]
    assert tuples(star.read_sources(spark, root), "name") == [("b",)]
    star.delete_topics(spark, root, spark.createDataFrame([(1,)], "topic_id int"))
    assert [f[0] for f in _facts(spark, root)] == [2]
    assert tuples(star.read_topics(spark, root), "topic_id") == [(0,)]


def test_upsert_replaces_with_null_and_keeps_the_rest(spark):
    table = spark.createDataFrame([(1, "a", 1.0, 5), (2, "b", 2.0, 6)], "k int, name string, score double, extra int")
    batch = spark.createDataFrame([(2, "x", None), (3, "c", 3.0), (3, "d", 4.0)], "k int, name string, score double")
    merged = merging.upsert(table, batch, ["k"], ["score"])
    assert tuples(merged) == [(1, "a", 1.0, 5), (2, "b", None, 6), (3, "c", 3.0, None)]
    assert tuples(merging.upsert(merged, batch, ["k"], ["score"])) == tuples(merged)


def test_insert_missing_keeps_the_first(spark):
    table = spark.createDataFrame([(1, "a")], "k int, name string")
    batch = spark.createDataFrame([(1, "z"), (2, "c"), (2, "b")], "k int, name string")
    assert tuples(merging.insert_missing(table, batch, ["k"])) == [(1, "a"), (2, "b")]


def test_constraints(spark):
    frame = spark.createDataFrame([(1, "a", 0.5), (1, None, 1.5), (2, "c", None)], "k int, name string, score double")
    assert tuples(constraints.null_violations(frame, ["name"]), "k") == [(1,)]
    assert tuples(constraints.key_violations(frame, ["k"])) == [(1, 2)]
    assert tuples(constraints.range_violations(frame, "score", 0, 1), "score") == [(1.5,)]
    parents = spark.createDataFrame([("a",), (None,)], "n string")
    assert tuples(constraints.orphans(frame, "name", parents, "n"), "k") == [(2,)]
    with pytest.raises(constraints.ConstraintError):
        constraints.require_none(constraints.key_violations(frame, ["k"]), "keys")
    constraints.require_none(constraints.key_violations(frame, ["k", "name"]), "keys")


def test_merge_keeps_all_documents(spark):
    docs = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "id long, published_at date")
    sources = spark.createDataFrame([(1, "a")], schemas.DOC_SOURCE)
    merged = merge_documents(docs, sources)
    assert tuples(merged, "article_id", "source_name", "topic_id", "sentiment_score") == [(1, "a", None, None), (2, None, None, None)]


def test_importance(spark):
    import math

    facts = spark.createDataFrame(
        [(1, "a", 0, 0.5), (2, "unknown", 0, -1.0), (3, None, None, 0.0), (4, "a", 1, None)],
        "article_id long, source_name string, topic_id int, sentiment_score double",
    )
    sources = _sources(spark, ("a", "x", 0.8))
    got = {r["article_id"]: r["importance_score"] for r in importance(facts, sources).collect()}
    assert got[1] == pytest.approx(0.5 * 0.8 + 0.3 * 0.5 + 0.2 * math.log(3))
    assert got[2] == pytest.approx(-0.3 + 0.2 * math.log(3))
    assert got[3] == pytest.approx(0.0)
    assert got[4] is None
    listed = spark.createDataFrame([(1, "[x (ORG)]")], schemas.ENTITIES)
    attached = attach_entities(importance(facts, sources), listed)
    assert attached.columns[-2:] == ["id", "entities"] and attached.count() == 4


@pytest.mark.parametrize("limit", [None, 0])
def test_rankings(spark, limit, monkeypatch):
    from newsloom.operators import joins

    if limit == 0:
        monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    facts = spark.createDataFrame(
        [(1, 1, 1, dt.date(2024, 1, 5), 1.0), (2, 1, 2, dt.date(2024, 1, 9), 3.0), (3, 2, 3, dt.date(2024, 1, 9), None),
         (4, 2, 1, dt.date(2024, 2, 9), None), (5, 3, 1, dt.date(2024, 2, 9), 4.0), (6, 9, 9, dt.date(2024, 2, 9), 4.0)],
        "article_id int, source_id int, topic_id int, published_at date, importance_score double",
    )
    topics = spark.createDataFrame([(1, "moon"), (2, "moon"), (3, "mars")], "topic_id int, name string")
    months = monthly_trends(facts, topics).collect()
    assert [(r["month"].month, r["topic"], r["article_count"], r["rank"]) for r in months] == [
        (2, "moon", 2, 1), (1, "moon", 2, 1), (1, "mars", 1, 2),
    ]
    sources = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "none")], "source_id int, name string")
    got = [tuple(r) for r in influential_sources(facts, sources).collect()]
    assert got == [("b", 2, None, 1), ("a", 2, 2.0, 2), ("c", 1, 4.0, 3)]


def test_small_buckets_share_folders(spark, root):
    """A folder and a few files for all buckets of a month, whatever their size; what is replaced goes in time."""
    from newsloom.sources.files import children

    sources, topics = _sources(spark, ("a", "x", 1.0), ("b", "y", 1.0)), _topics(spark, (0, "n", "c"))

    def load(low, high, score):
        ids = spark.range(low, high).selectExpr(
            "id as article_id", "if(id = 150, 'b', 'a') as source_name", "0 as topic_id", "date '2031-05-01' as published_at"
        )
        scored = ids.withColumns({"sentiment_score": F.lit(score), "importance_score": F.lit(score)})
        star.load_batch(spark, root, scored, sources, topics, bucket_rows=2)
        facts = star.read_facts(spark, root)
        assert facts.count() == facts.select("article_id").distinct().count() == 1000
        assert facts.where(F.col("sentiment_score") == score).count() == high - low
        total = facts.agg(F.sum("importance_score")).first()[0]
        assert star.read_sums(spark, root).agg(F.sum("score_sum")).first()[0] == total

    def folders(name="fact_article"):
        base = f"{root}/{name}"
        return {v: children(spark, f"{base}/{v}/month=2031-05") for v in children(spark, base)}

    load(0, 1000, 1.0)
    buckets = len(star._listed(spark, root))
    assert buckets >= 250 and [len(f) for f in folders().values()] == [1]
    load(0, 100, 2.0)  # a tenth of the folder: the rest is read from where it was
    assert list(folders()) == list(folders("fact_sums")) == ["version=1", "version=2"]
    assert sum(v == 1 for v in star._listed(spark, root).values()) > buckets * 0.8
    load(100, 600, 3.0)  # less than half is left: it is written anew
    assert list(folders()) == list(folders("fact_sums")) == ["version=2", "version=3"]
    star.delete_sources(spark, root, spark.createDataFrame([("b",)], "name string"))
    on_disk = spark.read.parquet(f"{root}/fact_article")
    assert star.read_facts(spark, root).count() == 999 and on_disk.where("article_id = 150").isEmpty()

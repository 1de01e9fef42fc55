from __future__ import annotations

import math
import random
from collections import Counter

import pandas as pd
import pytest
from conftest import tuples
from pyspark.sql import functions as F

from newsloom.functions.stopwords import ENGLISH
from newsloom.operators import entities as ent
from newsloom.operators import joins, profiles, sentiment, topics, words


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(11)
    vocabulary = ["the", "rocket", "moon", "Falcon", "9", "space", "center", "", "kennedy", "good", "bad", "$5m", "2024"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(0, 40))) for _ in range(120)]
    return spark.createDataFrame([*enumerate(texts), (500, None)], "id long, summary string").repartition(4)


def _texts(docs):
    return {r["id"]: r["summary"] for r in docs.collect()}


def test_word_counts_against_python(docs):
    counts = Counter(
        w for t in _texts(docs).values() if t is not None for w in t.lower().split(" ") if w not in set(ENGLISH)
    )
    result = words.word_counts(docs).collect()
    assert {r["filtered_words"]: r["count"] for r in result} == counts
    assert [(-r["count"], r["filtered_words"]) for r in result] == sorted((-n, w) for w, n in counts.items())


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
def test_tfidf_against_python(docs, limit, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
    texts = _texts(docs)
    tf = {i: Counter(w for w in t.lower().split(" ") if w not in set(ENGLISH)) for i, t in texts.items() if t is not None}
    df = Counter(w for c in tf.values() for w in c)
    got = {(r["id"], r["term"]): r["tfidf"] for r in words.tfidf_terms(docs).collect()}
    want = {(i, w): n * math.log((len(texts) + 1) / (df[w] + 1)) for i, c in tf.items() for w, n in c.items()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_topic_labels_break_ties_by_word(spark):
    counts = spark.createDataFrame(
        [(0, "b", 2), (0, "a", 2), (0, "c", 5), (1, "", 3), (1, "x" * 300, 9)], "topic_id int, word string, count long"
    )
    labels = {r["topic_id"]: (r["name"], r["category"]) for r in topics.topic_labels(counts).collect()}
    assert labels == {0: ("c, a, b", "c"), 1: ("x" * 255, "x" * 255)}
    assert tuples(topics.topic_categories(counts)) == [(0, "c"), (1, "x" * 255)]


def test_label_words_always_fill_a_label(spark):
    counts = spark.createDataFrame(
        [(0, "" if i == 0 else chr(0x4E00 + i), 1) for i in range(300)], "topic_id int, word string, count long"
    )
    name = topics.topic_labels(counts).first()["name"]
    assert name == ", ".join(sorted("" if i == 0 else chr(0x4E00 + i) for i in range(300)))[:255]


def test_top_words_are_limited_before_the_shuffle(spark):
    ids = spark.range(1000)
    counts = ids.select((F.col("id") % 2).alias("topic_id"), F.col("id").cast("string").alias("word"), F.col("id").alias("count"))
    plan = topics.top_words(counts, 100)._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning(topic_id")
    assert plan.index("WindowGroupLimit") < exchange < plan.rindex("WindowGroupLimit")


def test_classify_topics(docs):
    clustered, labels = topics.classify_topics(docs, 3)
    assigned = clustered.select("id", "topic_id").collect()
    assert len(assigned) == 121 and {r["topic_id"] for r in assigned} <= {0, 1, 2}
    used = {r["topic_id"] for r in assigned}
    assert {r["topic_id"] for r in labels.collect()} <= used
    again, _ = topics.classify_topics(docs, 3)
    assert tuples(again, "id", "topic_id") == tuples(clustered, "id", "topic_id")


def test_classify_empty(docs):
    clustered, labels = topics.classify_topics(docs.where("false"))
    assert clustered.select("id", "topic_id").count() == 0 and labels.count() == 0
    empty = docs.where("false").withColumn("title", F.lit(""))
    assert topics.classify_articles(empty).columns == ["title", "summary", "cluster"]


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
def test_sentiment_is_the_mean_polarity(docs, limit, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
    got = {r["id"]: (r["sentiment_score"], r["sentiment"]) for r in sentiment.sentiment(docs).collect()}
    for key, text in _texts(docs).items():
        hits = [sentiment.POLARITY[w] for w in ((text or "").lower().split(" ")) if w in sentiment.POLARITY]
        score = sum(hits) / len(hits) if hits else 0.0
        label = "positive" if score > 1e-9 else "negative" if score < -1e-9 else "neutral"
        assert got[key][0] == pytest.approx(score, abs=1e-6)
        if abs(score) > 1e-9 or not hits:
            assert got[key][1] == label


def test_marks_at_the_ends_of_words_do_not_count(spark):
    frame = spark.createDataFrame([(1, "the launch was great."), (2, '"Great," (bad)!'), (3, "g.reat")], "id long, summary string")
    got = {r["id"]: round(r["sentiment_score"], 4) for r in sentiment.sentiment(frame).collect()}
    assert got == {1: 0.8, 2: 0.05, 3: 0.0}


def test_more_clusters_than_documents(spark):
    for texts in (["moon"], ["moon"] * 3, ["moon", "mars"], ["", None], ["a b", "c d", "e f", "g h", "i j", "k l"]):
        frame = spark.createDataFrame([*enumerate(texts)], "id long, summary string")
        clustered, labels = topics.classify_topics(frame)
        rows = clustered.collect()
        assert len(rows) == len(texts) and all(0 <= r["topic_id"] < topics.CLUSTERS for r in rows)
        assert labels.count() <= topics.CLUSTERS


def test_sentiment_with_a_model(docs):
    @F.pandas_udf("double")
    def length(texts: pd.Series) -> pd.Series:
        return texts.str.len() / 1000.0

    got = {r["id"]: r["sentiment_score"] for r in sentiment.sentiment(docs, scorer=length).collect()}
    assert got == {i: pytest.approx(len(t or "") / 1000, abs=1e-6) for i, t in _texts(docs).items()}


def _entities(text: str | None) -> list[tuple[str, str]]:
    import re

    if text is None:
        return []
    tokens = [t.strip(ent.OUTER) for t in " ".join(text.lower().split()).split(" ")]
    found = []
    for pos, token in enumerate(tokens):
        for size in range(1, 5):
            surface = " ".join(tokens[pos : pos + size])
            if pos + size <= len(tokens) and surface in ent.NAMES:
                found.append((pos, -size, surface, ent.NAMES[surface]))
        for label, pattern in ent.FORMS:
            if token not in ent.NAMES and re.search(pattern, token):
                found.append((pos, -1, token, label))
                break
    found.sort()
    kept = []
    for i, (pos, minus, surface, label) in enumerate(found):
        if not any(p - m >= pos - minus for p, m, _, _ in found[:i]):
            kept.append((surface, label))
    return kept


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
def test_entities_against_python(docs, limit, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
    got = {r["id"]: [tuple(e) for e in r["entities"]] for r in ent.entities(docs).collect()}
    assert got == {i: _entities(t) for i, t in _texts(docs).items()}
    assert any(len(e) > 3 for e in got.values())


def test_entities_text_and_overlaps(spark):
    frame = spark.createDataFrame(
        [(1, "At Kennedy Space Center, NASA spent $5m (3.5%) in 2024; nasa"), (2, "nothing"), (3, None)],
        "id int, summary string",
    )
    written = tuples(ent.entities_as_text(ent.entities(frame)))
    assert written == [
        (1, "[kennedy space center (FAC), nasa (ORG), $5m (MONEY), 3.5% (PERCENT), 2024 (DATE), nasa (ORG)]"),
        (2, "[]"),
        (3, "[]"),
    ]


def test_entities_with_a_model(docs):
    def tagger(batches):
        for batch in batches:
            yield pd.DataFrame(
                {"id": batch["id"], "entities": [[{"text": t[:3], "label": "X"}] if t else [] for t in batch["text"]]}
            )

    got = {r["id"]: [tuple(e) for e in r["entities"]] for r in ent.entities(docs, tagger=tagger).collect()}
    assert got == {i: [(t[:3], "X")] if t else [] for i, t in _texts(docs).items()}


def test_profiles(spark):
    frame = spark.createDataFrame(
        [(1, "a", "http://z.example/1", "2024-01-01"), (2, "a", "http://b.example/2", "2024-01-02"),
         (None, "a", None, "2024-01-02"), (4, "b", "nohost", None)],
        "id int, news_site string, url string, published_at string",
    )
    assert tuples(profiles.source_reliability(frame)) == [("a", "b.example", 0.5), ("b", None, 0.25)]
    assert profiles.source_reliability(frame.where("false")).count() == 0
    assert [tuple(r) for r in profiles.site_counts(frame).collect()] == [("a", 3), ("b", 1)]
    assert [tuple(r) for r in profiles.publication_trend(frame).collect()] == [
        ("2024-01-02", 2), ("2024-01-01", 1), (None, 1),
    ]


def test_tasks_of_kmeans_hold_a_bounded_share(spark, monkeypatch):
    """More documents make more parts, not larger ones, and the clusters do not hang on how the input is cut."""
    parts = []
    fit = topics.KMeans.fit

    def counted(self, rows, *args):
        parts.append(rows.rdd.getNumPartitions())
        return fit(self, rows, *args)

    monkeypatch.setattr(topics.KMeans, "fit", counted)
    monkeypatch.setattr(topics, "TASK_VALUES", 10 * topics.BUCKETS)
    docs = spark.range(400).selectExpr("id", "concat('w', id % 7, ' v', id % 11) as summary")
    found = [tuples(topics.classify_topics(d, 3)[0], "id", "topic_id") for d in (docs.coalesce(1), docs.repartition(5))]
    assert parts == [40, 40] and found[0] == found[1]


def test_topics_and_labels_read_the_words_written_once(spark):
    """The text is cut into words once; columns of any other name stay as they are."""
    docs = spark.range(60).selectExpr("id", "concat('w', id % 7, ' v', id % 11) as summary", "id * 2 as place")
    clustered, labels = topics.classify_topics(docs, 3)
    for found in (clustered, labels):
        files = found.inputFiles()
        assert files and all("/counted-" in file for file in files)
    assert tuples(clustered, "id", "place") == [(i, 2 * i) for i in sorted(range(60), key=lambda i: repr((i, 2 * i)))]
    again = topics.assign_topics(docs, topics.fit_topics(docs, 3))
    assert tuples(again, "id", "topic_id") == tuples(clustered, "id", "topic_id")

from __future__ import annotations

import json
import os
import tempfile

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.plans.analysis import analyze, analyze_rows
from newsloom.plans.daily import extract_pages, run_daily
from newsloom.session import scratch_dir, scratch_run, spool, with_scratch
from newsloom.sources import readers, star, writers
from newsloom.sources.files import children
from newsloom.streaming.incremental import first_arrivals, incremental_load, read_first


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")


def _record(number, day, summary="", **other):
    return {
        "id": number, "title": f'Title "{number}", part', "url": f"http://s{number % 2}.example/{number}", "image_url": "",
        "news_site": f"site{number % 2}", "summary": summary, "published_at": f"{day}T10:00:00Z",
        "updated_at": f"{day}T11:00:00Z", "featured": False, "launches": [{"launch_id": "x"}], "events": [],
    } | other


def _deliver(spark, folder, date, **types):
    for name, records in types.items():
        pages = f"{folder}/pages/{date}/{name}"
        os.makedirs(pages)
        with open(f"{pages}/p.json", "w") as file:
            for record in records:
                file.write(json.dumps({"count": len(records), "results": [record]}) + "\n")
            file.write(json.dumps({"detail": "no more"}) + "\n")
        extract_pages(spark, pages, f"{folder}/inbox/{date}/{name}.csv")


TEXTS = ["good rocket moon", "bad crash mars", "nasa spacex great win", "", "rocket rocket moon base", "mars\nrover great"]


def _two_days(spark, folder):
    first = [_record(i, "2025-01-31", TEXTS[i]) for i in range(6)]
    _deliver(spark, folder, "2025-02-01", articles=first, blogs=[_record(1, "2025-01-31", "bad bad")])
    later = [_record(i, "2025-02-01", TEXTS[i % 6]) for i in range(6, 10)]
    again = [_record(2, "2025-01-31", "terrible loss")]
    _deliver(spark, folder, "2025-02-02", articles=later + again, reports=[_record(20, "2025-02-02", "great moon")])


def test_csv_quotes_survive(spark, folder, rows):
    docs = readers.read_rows(spark, [rows[0] | {"title": 'He said "go", twice', "image_url": None}, rows[1] | {"url": None}])
    path = writers.write_csv(docs, f"{folder}/x.csv")
    assert tuples(readers.read_csv(spark, path)) == tuples(docs)
    path = writers.write_csv(docs.withColumn("title", F.lit("")), f"{folder}/z.csv")
    assert tuples(readers.read_csv(spark, path), "title") == [(None,), (None,)]
    lines = docs.withColumn("summary", F.lit("a\nb"))
    path = writers.write_csv(lines, f"{folder}/y.csv")
    assert tuples(readers.read_csv(spark, path)) == tuples(lines)


ODD = ["\tmars", "mars", "mars\t", " a ", 'say "x", y', "a\r\nb\rc\nd", "back\\slash", "\\", '"', ",", "\n"]


def test_csv_keeps_odd_values(spark, folder):
    frame = spark.createDataFrame([*enumerate(ODD)], "n int, word string").repartition(3)
    path = writers.write_csv(frame, f"{folder}/odd.csv")
    assert tuples(readers.read_csv(spark, path, frame.schema)) == tuples(frame)


def test_missing_inputs_are_skipped(spark, folder, rows):
    docs = readers.read_rows(spark, rows)
    here = writers.write_csv(docs, f"{folder}/articles.csv")
    assert readers.read_docs(spark, [here, f"{folder}/blogs.csv"]).count() == len(rows)
    assert readers.read_docs(spark, [f"{folder}/blogs.csv"]).schema == schemas.RAW
    assert list(readers.read_doc_types(spark, {"articles": here, "blogs": f"{folder}/none"})) == ["articles"]
    assert run_daily(spark, "2025-01-01", f"{folder}/nothing", f"{folder}/out") is None


def test_raw_sink_writes_nothing_without_records(spark, folder, rows):
    docs = readers.read_rows(spark, rows)
    assert writers.write_raw(docs.where("false"), f"{folder}/e.csv") == f"{folder}/e.csv"
    assert children(spark, f"{folder}/e.csv") == []
    writers.write_raw(docs, f"{folder}/e.csv")
    assert readers.read_csv(spark, f"{folder}/e.csv").count() == len(rows)


def test_csv_has_the_parts_that_the_caller_says(spark, folder):
    frame = spark.range(100).repartition(4)

    def parts(path):
        return len([c for c in children(spark, path) if c.startswith("part")])

    assert parts(writers.write_csv(frame, f"{folder}/one.csv", parts=1)) == 1
    path = writers.write_csv(frame, f"{folder}/many.csv")
    assert parts(path) == 4 and spark.read.option("header", True).csv(path).count() == 100


def test_partitioned_sink_overwrites_static_and_dynamic(spark, folder):
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "n int, day string")
    path = writers.write_partitioned(frame, f"{folder}/p", "day")
    writers.write_partitioned(frame.where("n = 2").withColumn("n", F.lit(5)), path, "day", mode="dynamic")
    assert tuples(spark.read.parquet(path)) == [(1, "a"), (5, "b")]
    writers.write_partitioned(frame.where("n = 2"), path, "day")
    assert tuples(spark.read.parquet(path)) == [(2, "b")]


def test_since(spark, rows):
    docs = readers.read_rows(spark, rows)
    assert readers.since(docs, None).count() == 3
    assert tuples(readers.since(docs, "2031-05-04"), "id") == [(41,), (42,)]


def test_spool_uses_the_shared_folder(spark):
    assert spool(spark.range(3)).inputFiles()[0].startswith("file:")
    assert scratch_dir(spark) in spool(spark.range(3)).inputFiles()[0].replace("file://", "file:")


def test_a_run_leaves_nothing_along_the_way(spark):
    before = children(spark, scratch_dir(spark))
    with scratch_run(spark) as run:
        inside = spool(spark.range(3))
        with scratch_run(spark) as inner:
            assert inner == run
        assert inside.count() == 3 and len(children(spark, run)) == 1
    assert children(spark, scratch_dir(spark)) == before


def test_a_folder_is_required_on_a_cluster(monkeypatch):
    class Conf:
        get = staticmethod(lambda *_: None)

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext, conf = Context, Conf

    assert with_scratch(Session) is Session
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session)


def test_analyze_rows(spark, rows):
    frames = analyze_rows(spark, rows, clusters=2)
    assert set(frames) == {"words", "entities", "trend", "sites", "clusters"}
    counts = {r["filtered_words"]: r["count"] for r in frames["words"].collect()}
    assert counts["lander"] == 2 and "a" not in counts
    found = {r["id"]: [tuple(e) for e in r["entities"]] for r in frames["entities"].collect()}
    assert found == {41: [("nasa", "ORG"), ("moon", "LOC")], 42: [("mars", "LOC")], 7: []}
    assert [(str(r["published_at"]), r["count"]) for r in frames["trend"].collect()] == [("2031-05-04", 2), ("2030-12-31", 1)]
    assert tuples(frames["sites"]) == [("Alpha", 2), ("Beta", 1)]
    assert frames["clusters"].columns == ["title", "summary", "cluster"] and frames["clusters"].count() == 3


def test_analyze_few_rows_with_more_clusters(spark, rows):
    for some in (rows[:1], [rows[0]] * 3, [rows[2]] * 2, rows):
        found = analyze_rows(spark, some)["clusters"].collect()
        assert len(found) == len(some) and all(0 <= r["cluster"] < 5 for r in found)


def test_analyze_nothing(spark):
    assert {n: f.count() for n, f in analyze_rows(spark, []).items()} == dict.fromkeys(
        ("words", "entities", "trend", "sites", "clusters"), 0
    )


def test_analyze_dates_already_cast(spark, rows):
    docs = readers.read_rows(spark, rows).withColumn("published_at", F.col("published_at").cast("date"))
    assert analyze(docs, clusters=2)["trend"].count() == 2  # two days


@pytest.fixture(scope="module")
def two_days(spark):
    """Two dates run in order: the folder, and the tables of the first."""
    folder = tempfile.mkdtemp(prefix="days-")
    _two_days(spark, folder)
    inbox, out, root = f"{folder}/inbox", f"{folder}/out", f"{folder}/star"
    tables = run_daily(spark, "2025-02-01", inbox, out, root, clusters=2, csv=True)
    run_daily(spark, "2025-02-02", inbox, out, root, clusters=2)
    return folder, tables


def test_daily_run(spark, two_days):
    folder, tables = two_days
    assert tuples(tables["clean"], "id") == [(i,) for i in range(6)]
    assert tables["clean"].where("id = 5").first()["summary"] == "mars rover great"
    assert tuples(tables["sources"]) == [("site0", "s0.example", 0.5), ("site1", "s1.example", 0.5)]
    assert tables["clean"].where("id = 1").first()["launches"] == '[{"launch_id": "x"}]'
    assert tuples(tables["merged"], "article_id") == [(i,) for i in range(6)]
    scored = {r["article_id"]: r for r in tables["scored"].collect()}
    assert scored[2]["entities"] == "[nasa (ORG), spacex (ORG)]" and scored[2]["sentiment_score"] == pytest.approx(0.8)
    assert children(spark, f"{folder}/out/2025-02-01/topics_csv")
    written = readers.read_csv(spark, f"{folder}/out/2025-02-01/entities_csv", schemas.ENTITIES)
    assert written.count() == 6


def test_star_after_two_days(spark, two_days):
    root = f"{two_days[0]}/star"
    facts = {r["article_id"]: r for r in star.read_facts(spark, root).collect()}
    assert sorted(facts) == [*range(10), 20]
    assert facts[2]["sentiment_score"] == pytest.approx(-0.65) and facts[2]["source_id"] == 1
    names = tuples(star.read_sources(spark, root), "source_id", "name")
    assert names == [(1, "site0"), (2, "site1")]


def test_a_date_run_again_changes_nothing(spark, two_days):
    folder = two_days[0]
    before = tuples(star.read_facts(spark, f"{folder}/star"))
    run_daily(spark, "2025-02-02", f"{folder}/inbox", f"{folder}/out", f"{folder}/star", clusters=2)
    assert tuples(star.read_facts(spark, f"{folder}/star")) == before


def test_incremental_load_equals_the_daily_runs(spark, two_days):
    folder = two_days[0]
    for _ in range(2):  # nothing new the second time
        incremental_load(
            spark, f"{folder}/inbox", f"{folder}/out2", f"{folder}/star2", f"{folder}/progress", clusters=2
        ).awaitTermination()
    columns = [c for c in schemas.FACT.fieldNames() if c not in ("topic_id", "importance_score")]
    assert tuples(star.read_facts(spark, f"{folder}/star2"), *columns) == tuples(
        star.read_facts(spark, f"{folder}/star"), *columns
    )
    assert tuples(star.read_sources(spark, f"{folder}/star2")) == tuples(star.read_sources(spark, f"{folder}/star"))


def test_daily_run_leaves_nothing_along_the_way(spark, two_days):
    folder = two_days[0]
    before = children(spark, scratch_dir(spark))
    run_daily(spark, "2025-02-01", f"{folder}/inbox", f"{folder}/out3", f"{folder}/star3", clusters=2)
    assert children(spark, scratch_dir(spark)) == before


def test_one_document_is_a_day(spark, folder):
    _deliver(spark, folder, "2025-03-01", articles=[_record(1, "2025-02-28", "")])
    tables = run_daily(spark, "2025-03-01", f"{folder}/inbox", f"{folder}/out", f"{folder}/star")
    assert tables["scored"].count() == star.read_facts(spark, f"{folder}/star").count() + tables["refused_facts"].count() == 1


def test_equal_ids_of_two_types_stay_two_facts(spark, folder):
    same = [_record(5, "2025-02-28", "good moon"), _record(6, "2025-02-28", "bad mars")]
    _deliver(spark, folder, "2025-03-01", articles=same, blogs=[_record(5, "2025-02-28", "terrible loss")])
    tables = run_daily(spark, "2025-03-01", f"{folder}/inbox", f"{folder}/out", f"{folder}/star", clusters=2, keys=("doc_type", "id"))
    assert tuples(tables["merged"], "article_id") == [(15,), (17,), (18,)]
    assert tuples(star.read_facts(spark, f"{folder}/star"), "article_id") == [(15,), (17,), (18,)]


def test_topics_of_each_date(spark, folder):
    _two_days(spark, folder)
    for date in ("2025-02-01", "2025-02-02"):
        run_daily(spark, date, f"{folder}/inbox", f"{folder}/out", f"{folder}/star", clusters=2, topics_by_date=True)
    ids = {r["topic_id"] for r in star.read_topics(spark, f"{folder}/star").collect()}
    days = {i // 1000 for i in ids}
    assert len(days) == 2 and {i % 1000 for i in ids} <= {0, 1}
    assert {r["topic_id"] for r in star.read_facts(spark, f"{folder}/star").collect()} <= ids


def test_a_late_file_gives_what_one_delivery_gives(spark, folder):
    first = [_record(i, "2025-01-31", TEXTS[i]) for i in range(5)]
    late = [_record(20 + i, "2025-01-31", TEXTS[i]) for i in range(3)]
    _deliver(spark, f"{folder}/whole", "2025-02-01", articles=first, reports=late)
    _deliver(spark, f"{folder}/late", "2025-02-01", articles=first)
    _deliver(spark, f"{folder}/late", "no-date", articles=late)

    def load(name):
        own = f"{folder}/{name}"
        incremental_load(spark, f"{own}/inbox", f"{own}/out", f"{own}/star", f"{own}/progress", clusters=2).awaitTermination()

    load("whole")
    load("late")
    assert spark.read.parquet(f"{folder}/late/out/2025-02-01/clean").count() == 5
    refused = spark.read.parquet(f"{folder}/late/out/refused_files")
    assert {r["folder"] for r in refused.collect()} == {"no-date"}
    _deliver(spark, f"{folder}/late", "2025-02-01", reports=late)
    load("late")
    for table in ("clean", "scored", "topics", "words", "sources", "trend", "sites"):
        got, wanted = (spark.read.parquet(f"{folder}/{n}/out/2025-02-01/{table}") for n in ("late", "whole"))
        assert tuples(got, *sorted(wanted.columns)) == tuples(wanted, *sorted(wanted.columns)), table


def test_a_load_lists_new_files_once_and_writes_words_without_texts(spark, folder, monkeypatch):
    from newsloom.operators import topics
    from newsloom.streaming import incremental

    spooled, spool = [], topics.spool

    def noted(df, label="spool"):
        spooled.append((label, tuple(df.columns)))
        return spool(df, label)

    monkeypatch.setattr(topics, "spool", noted)
    monkeypatch.setattr(incremental, "spool", noted, raising=False)
    _deliver(spark, folder, "2025-02-01", articles=[_record(i, "2025-01-31", TEXTS[i]) for i in range(5)])
    _deliver(spark, folder, "no-date", articles=[_record(9, "2025-01-31", TEXTS[0])])
    incremental_load(spark, f"{folder}/inbox", f"{folder}/out", None, f"{folder}/progress", clusters=2).awaitTermination()
    assert [columns for label, columns in spooled if label == "files"] == [("folder", "file")]
    assert [columns for label, columns in spooled if label == "counted"] == [("id", "filtered_words", "raw_features", "_place")]
    assert spark.read.parquet(f"{folder}/out/2025-02-01/doc_topics").count() == 5
    assert spark.read.parquet(f"{folder}/out/refused_files").count() == 1


@pytest.mark.parametrize("files", [1, 3])
def test_first_arrivals(spark, folder, files):
    frame = spark.createDataFrame(
        [(1, "2025-01-01 10:40:00", "b"), (1, "2025-01-01 10:10:00", "a"), (1, "2025-01-01 11:00:00", "c"),
         (2, "2025-01-01 10:00:00", "e"), (2, "2025-01-01 10:00:00", "d"), (1, "2024-01-01 10:00:00", "late")],
        "id int, updated_at string, title string",
    ).withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    frame.repartition(files, "title").write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    first_arrivals(stream, f"{folder}/o", f"{folder}/c", ("id",), "updated_at", "1 hour").awaitTermination()
    assert tuples(read_first(spark, f"{folder}/o", ("id",)), "id", "title") == [(1, "a"), (1, "c"), (1, "late"), (2, "d")]


def test_a_run_in_buckets_from_split_files_gives_the_same(spark, two_days):
    folder, tables = two_days
    out = f"{folder}/bucketed"
    got = run_daily(spark, "2025-02-01", f"{folder}/inbox", out, clusters=2, split=True, buckets=3)
    assert got.keys() == tables.keys() - {n for n in tables if n.startswith("refused_")}
    for name in ("clean", "scored", "merged", "doc_sources", "sentiment", "entities"):
        assert tuples(got[name], *sorted(got[name].columns)) == tuples(tables[name], *sorted(got[name].columns)), name

"""The daily batch, from delivered files to the star schema."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.operators.cleaning import clean, conform, deduplicate, normalize, union_doc_types
from newsloom.operators.constraints import split_valid
from newsloom.operators.entities import entities, entities_as_text
from newsloom.operators.facts import daily_insights, merge_documents
from newsloom.operators.profiles import doc_sources, publication_trend, site_counts, source_reliability
from newsloom.operators.sentiment import sentiment
from newsloom.operators.topics import CLUSTERS, classify_topics
from newsloom.operators.words import word_counts
from newsloom.session import scratch_run, spool
from newsloom.sources import readers, star, writers
from newsloom.sources.bucketed import write_bucketed

DOC_TYPES = ("articles", "reports", "blogs")

# Tables with a row for each document.
PER_DOCUMENT = ("doc_dates", "doc_sources", "doc_topics", "sentiment", "entities")

# Clusters that a date can have where each date has topics of its own.
TOPICS_OF_A_DATE = 1000


def extract_pages(
    spark: SparkSession, pages: str, out: str, since: str | None = None, missing_id: int | None = None
) -> str:
    """Stored service pages to one raw CSV folder of one document type."""
    records = normalize(readers.read_pages(spark, pages), missing_id)
    return writers.write_raw(readers.since(records, since), out)


def clean_docs(batches: dict[str, DataFrame], keys=("id",)) -> tuple[DataFrame, DataFrame]:
    """All document types cleaned and deduplicated, and the rows refused for want of an id.

    With ``keys`` = ("doc_type", "id") equal ids of different types stay apart.
    The batch is read once: what follows reads the written rows.
    """
    delivered = spool(union_doc_types(batches), "delivered")
    known, refused = split_valid(delivered, F.col("id").isNotNull())
    return deduplicate(clean(known), keys), refused


def typed_id(doc_type: str = "doc_type", key: str = "id") -> Column:
    """One id for a document type and an id in it: the id times the number of types, and the type's place."""
    place = F.array_position(F.array(*(F.lit(t) for t in DOC_TYPES)), F.col(doc_type)) - 1
    return (F.col(key) * len(DOC_TYPES) + place).cast("long")


def dated_topic(date: str, topic: str = "topic_id") -> Column:
    """One id for a date and a cluster of it: days since 1970 times 1000, and the cluster."""
    return (F.unix_date(F.lit(date).cast("date")) * TOPICS_OF_A_DATE + F.col(topic)).cast("int")


def run_daily(
    spark: SparkSession,
    date: str,
    inbox: str,
    out: str,
    warehouse: str | None = None,
    clusters: int = CLUSTERS,
    lexicon: DataFrame | None = None,
    gazetteer: DataFrame | None = None,
    scorer=None,
    tagger=None,
    multi_line: bool = True,
    csv: bool = False,
    keys: tuple[str, ...] = ("id",),
    topics_by_date: bool = False,
    split: bool = False,
    buckets: int | None = None,
) -> dict[str, DataFrame] | None:
    """Run one date: read ``inbox``/``date``, write ``out``/``date``, load ``warehouse``.

    Gives the written tables by name, or None when nothing was delivered.
    Running a date again replaces its folders and leaves the warehouse as it is.
    With ``topics_by_date`` a topic's id holds the date, so that each date keeps
    the labels of its own clusters; without, a cluster's number is the topic
    and keeps its first label. For ``keys`` see run_batch, for ``multi_line``
    and ``split`` read_csv.
    """
    paths = {t: f"{inbox}/{date}/{t}.csv" for t in DOC_TYPES}
    batches = readers.read_doc_types(spark, paths, multi_line, split)
    if not batches:
        return None
    return run_batch(
        spark, batches, f"{out}/{date}", warehouse, clusters, lexicon, gazetteer, scorer, tagger, csv, keys,
        date if topics_by_date else None, buckets,
    )


def run_batch(
    spark: SparkSession,
    batches: dict[str, DataFrame],
    folder: str,
    warehouse: str | None = None,
    clusters: int = CLUSTERS,
    lexicon: DataFrame | None = None,
    gazetteer: DataFrame | None = None,
    scorer=None,
    tagger=None,
    csv: bool = False,
    keys: tuple[str, ...] = ("id",),
    topics_of: str | None = None,
    buckets: int | None = None,
) -> dict[str, DataFrame]:
    """One batch of raw frames by document type. Every stage reads the written clean set.

    Tables are Parquet; ``csv`` writes each as CSV too, sources and topics as
    a single file. With ``keys`` = ("doc_type", "id") a document's id becomes
    typed_id, so that equal ids of two types are two documents to the end.
    With ``topics_of``, a date, a topic's id becomes dated_topic. With
    ``buckets`` what is known of each document is written in so many buckets
    of its id, and facts are put together bucket by bucket without a shuffle.
    What is written along the way is removed at the end.
    """
    with scratch_run(spark):
        return _run_batch(
            spark, batches, folder, warehouse, clusters, lexicon, gazetteer, scorer, tagger, csv, keys, topics_of, buckets
        )


def _run_batch(
    spark, batches, folder, warehouse, clusters, lexicon, gazetteer, scorer, tagger, csv, keys, topics_of, buckets
) -> dict[str, DataFrame]:
    cleaned, refused = clean_docs(batches, keys)
    if "doc_type" in keys:
        cleaned = cleaned.withColumn("id", typed_id())
    cleaned = conform(cleaned, schemas.CLEAN)
    writers.write_partitioned(cleaned, f"{folder}/clean", "published_at")
    writers.write_parquet(refused, f"{folder}/refused_documents")
    docs = spark.read.schema(schemas.CLEAN).parquet(f"{folder}/clean")

    def topics() -> dict[str, DataFrame]:
        clustered, labels = classify_topics(docs.select("id", "summary"), clusters, keep=("id",))
        found = {"doc_topics": clustered.select("id", "topic_id"), "topics": labels}
        if topics_of is None:
            return found
        if clusters > TOPICS_OF_A_DATE:
            raise ValueError(f"a date has {TOPICS_OF_A_DATE} topics at most")
        return {name: df.withColumn("topic_id", dated_topic(topics_of)) for name, df in found.items()}

    tables = _written_together(
        spark,
        folder,
        buckets,
        topics,
        lambda: {"entities": entities_as_text(entities(docs, gazetteer, tagger))},
        lambda: {"sentiment": sentiment(docs, lexicon, scorer)},
        lambda: {"words": word_counts(docs)},
        lambda: {"sources": source_reliability(docs), "doc_sources": doc_sources(docs)},
        lambda: {"trend": publication_trend(docs), "sites": site_counts(docs)},
        *([lambda: {"doc_dates": docs.select("id", "published_at")}] if buckets else []),
    )
    merged = merge_documents(
        tables.pop("doc_dates", docs), tables["doc_sources"], tables["doc_topics"], tables["sentiment"]
    )
    tables["merged"] = _stage(spark, merged, f"{folder}/merged")
    scored = daily_insights(tables["merged"], tables["sources"], tables["entities"])
    tables["scored"] = _stage(spark, scored, f"{folder}/scored")
    tables["clean"] = docs
    if csv:
        for name, df in tables.items():
            writers.write_csv(df, f"{folder}/{name}_csv", 1 if name in ("sources", "topics") else None)
    if warehouse is not None:
        bad = star.load_batch(spark, warehouse, tables["scored"], tables["sources"], tables["topics"])
        for name, df in bad.items():
            tables[f"refused_{name}"] = _stage(spark, df, f"{folder}/refused_{name}")
    return tables


def _written_together(
    spark: SparkSession, folder: str, buckets: int | None, *analyses: Callable[[], dict[str, DataFrame]]
) -> dict[str, DataFrame]:
    """Tables of analyses that do not need each other, their jobs submitted side by side.

    Stages of one fill the cores left free at the end of another.
    """

    def run(analysis: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
        return {
            name: write_bucketed(df, f"{folder}/{name}", "id", buckets)
            if buckets and name in PER_DOCUMENT
            else _stage(spark, df, f"{folder}/{name}")
            for name, df in analysis().items()
        }

    with ThreadPoolExecutor(len(analyses)) as pool:
        started = [
            pool.submit(copy_context().run, inheritable_thread_target(spark)(run), analysis) for analysis in analyses
        ]
        return {name: df for task in started for name, df in task.result().items()}


def _stage(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    writers.write_parquet(df, path)
    return spark.read.schema(df.schema).parquet(path)

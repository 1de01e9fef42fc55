"""Facts: one row per document with its source, topic, scores and entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newsloom import schemas
from newsloom.functions import scoring
from newsloom.operators.joins import lookup_join
from newsloom.session import spool


def merge_documents(
    docs: DataFrame,
    doc_sources: DataFrame | None = None,
    doc_topics: DataFrame | None = None,
    sentiment: DataFrame | None = None,
) -> DataFrame:
    """Left joins on ``id``; a missing side counts as empty.

    All sides share one key, so each is shuffled once, as two narrow columns.
    """
    sides = (
        (doc_sources, schemas.DOC_SOURCE, "source_name"),
        (doc_topics, schemas.DOC_TOPIC, "topic_id"),
        (sentiment, schemas.SENTIMENT, "sentiment_score"),
    )
    merged = docs.select("id", "published_at")
    for side, schema, column in sides:
        merged = merged.join(_or_empty(docs, side, schema).select("id", column), "id", "left")
    return merged.select(
        F.col("id").alias("article_id"), "source_name", "topic_id", "published_at", "sentiment_score"
    )


def importance(facts: DataFrame, sources: DataFrame) -> DataFrame:
    """Add ``importance_score`` from reliability, sentiment and the size of the topic in ``facts``."""
    reliability = sources.groupBy("source_name").agg(F.min("reliability_score").alias("_reliability"))
    topic_sizes = (
        facts.where(F.col("topic_id").isNotNull())
        .groupBy("topic_id")
        .agg(F.count("*").alias("_topic_size"))
    )
    scored = lookup_join(facts, spool(reliability, "reliability"), ["source_name"])
    scored = lookup_join(scored, spool(topic_sizes, "topic-sizes"), ["topic_id"])
    score = scoring.importance(F.col("_reliability"), F.col("sentiment_score"), F.col("_topic_size"))
    return scored.select(*facts.columns, score.alias("importance_score"))


def attach_entities(facts: DataFrame, entities: DataFrame) -> DataFrame:
    """Left join on ``article_id`` = ``id``; both keys stay."""
    return facts.join(entities, facts["article_id"] == entities["id"], "left")


def daily_insights(facts: DataFrame, sources: DataFrame, entities: DataFrame) -> DataFrame:
    return attach_entities(importance(facts, sources), entities)


def _or_empty(like: DataFrame, side: DataFrame | None, schema: StructType) -> DataFrame:
    return like.sparkSession.createDataFrame([], schema) if side is None else side

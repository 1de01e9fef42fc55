"""The two analytic questions over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.dates import month_start
from newsloom.operators.joins import small_enough
from newsloom.operators.ranking import ranked


def monthly_trends(
    facts: DataFrame,
    topics: DataFrame,
    key: str = "topic_id",
    published: str = "published_at",
    name: str = "name",
) -> DataFrame:
    """Articles per month and topic name, ranked within the month; latest month first.

    Topics that share a name are counted together.
    """
    month = month_start(F.col(published), facts.schema[published].dataType)
    return _trends(facts.select(key, month.alias("month"), F.lit(1).alias("_n")), topics, key, name)


def monthly_trends_of_sums(sums: DataFrame, topics: DataFrame) -> DataFrame:
    """The same from the sums that loads keep up to date (star.read_sums), without reading facts."""
    return _trends(sums.select("topic_id", F.to_timestamp("month", "yyyy-MM").alias("month"), F.col("rows").alias("_n")), topics)


def _trends(dated: DataFrame, topics: DataFrame, key: str = "topic_id", name: str = "name") -> DataFrame:
    topics = topics.select(key, F.col(name).alias("topic"))
    if small_enough(topics):
        named = dated.join(F.broadcast(topics), key)
    else:
        # One row per month and topic is left to be shuffled.
        named = dated.groupBy(key, "month").agg(F.sum("_n").alias("_n")).join(topics, key)
    counts = named.groupBy("month", "topic").agg(F.sum("_n").alias("article_count"))
    # one row per month and name is left, in most cases few
    return ranked(counts, [("article_count", "desc")], ["month"], aggregated=True).orderBy(F.desc("month"), "rank")


def influential_sources(
    facts: DataFrame,
    sources: DataFrame,
    key: str = "source_id",
    article: str = "article_id",
    score: str = "importance_score",
    name: str = "name",
) -> DataFrame:
    """Articles and mean importance per source name, ranked by both; a missing mean ranks first."""
    sums = (
        F.count(article).alias("_articles"),
        F.sum(score).alias("_sum"),
        F.count(score).alias("_scores"),
    )
    # One row per source is left to meet the names, whatever their number.
    return _influence(facts.groupBy(key).agg(*sums), sources, key, name)


def influential_sources_of_sums(sums: DataFrame, sources: DataFrame) -> DataFrame:
    """The same from the sums that loads keep up to date (star.read_sums), without reading facts."""
    totals = (F.sum("articles").alias("_articles"), F.sum("score_sum").alias("_sum"), F.sum("scores").alias("_scores"))
    return _influence(sums.groupBy("source_id").agg(*totals), sources)


def _influence(per_key: DataFrame, sources: DataFrame, key: str = "source_id", name: str = "name") -> DataFrame:
    sources = sources.select(key, F.col(name).alias("source_name"))
    totals = (
        per_key.join(sources, key)
        .groupBy("source_name")
        .agg(
            F.sum("_articles").alias("total_articles"),
            F.try_divide(F.sum("_sum"), F.sum("_scores")).alias("avg_importance"),
        )
    )
    order = [("total_articles", "desc"), ("avg_importance", "desc_nulls_first")]
    return ranked(totals, order, aggregated=True).orderBy("rank")

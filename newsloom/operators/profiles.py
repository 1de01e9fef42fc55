"""Counts per day and per source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import url_host


def publication_trend(df: DataFrame, day: str = "published_at") -> DataFrame:
    """Documents per day, latest day first."""
    return df.groupBy(day).agg(F.count("*").alias("count")).orderBy(F.desc(day))


def site_counts(df: DataFrame, site: str = "news_site") -> DataFrame:
    """Documents per source, most first."""
    return df.groupBy(site).agg(F.count("*").alias("count")).orderBy(F.desc("count"), site)


def doc_sources(df: DataFrame, key: str = "id", site: str = "news_site") -> DataFrame:
    return df.select(F.col(key).alias("id"), F.col(site).alias("source_name"))


def source_reliability(
    df: DataFrame, key: str = "id", site: str = "news_site", url: str = "url"
) -> DataFrame:
    """Per source its first host in the alphabet and its share of all documents.

    Counting per source and host first keeps the large step a hash aggregate
    of numbers; the smallest host is then taken among few rows.
    """
    total = df.agg(F.count("*").alias("n")).scalar()
    hosts = df.groupBy(site, url_host(F.col(url)).alias("_host")).agg(F.count(key).alias("_n"))
    return (
        hosts.groupBy(F.col(site).alias("source_name"))
        .agg(F.min("_host").alias("url"), F.sum("_n").alias("_n"))
        .select("source_name", "url", F.try_divide(F.col("_n"), total).alias("reliability_score"))
    )

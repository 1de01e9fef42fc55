"""The five analyses of a document set, without loading it anywhere."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.dates import leading_date
from newsloom.operators.entities import entities
from newsloom.operators.profiles import publication_trend, site_counts
from newsloom.operators.topics import CLUSTERS, classify_articles
from newsloom.operators.words import word_counts
from newsloom.sources.readers import read_rows


def analyze(
    df: DataFrame,
    clusters: int = CLUSTERS,
    gazetteer: DataFrame | None = None,
    tagger=None,
) -> dict[str, DataFrame]:
    """Frames by name: words, entities, trend, sites, clusters. Only the cluster fit runs now."""
    if dict(df.dtypes)["published_at"] == "string":
        df = df.withColumn("published_at", leading_date(F.col("published_at")))
    return {
        "words": word_counts(df),
        "entities": entities(df, gazetteer, tagger),
        "trend": publication_trend(df),
        "sites": site_counts(df),
        "clusters": classify_articles(df, clusters),
    }


def analyze_rows(spark: SparkSession, rows: Sequence[Mapping], **options) -> dict[str, DataFrame]:
    """The same for records held in memory; no records give empty frames."""
    return analyze(read_rows(spark, rows), **options)

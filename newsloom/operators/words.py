"""Word statistics."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions import text
from newsloom.functions.stopwords import ENGLISH
from newsloom.operators.joins import lookup_join
from newsloom.session import spool


def explode_words(
    df: DataFrame,
    summary: str = "summary",
    keep: Sequence[str] = (),
    stop_words: Iterable[str] = ENGLISH,
    alias: str = "word",
) -> DataFrame:
    """One row per token that is no stop word, with the ``keep`` columns beside it."""
    tokens = df.select(*keep, F.explode(text.words(F.col(summary))).alias(alias))
    return tokens.where(text.not_stop_word(F.col(alias), stop_words))


def word_counts(
    df: DataFrame, summary: str = "summary", stop_words: Iterable[str] = ENGLISH
) -> DataFrame:
    """Uses of each word, most used first."""
    tokens = explode_words(df, summary, stop_words=stop_words, alias="filtered_words")
    return (
        tokens.groupBy("filtered_words")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "filtered_words")
    )


def tfidf_terms(
    df: DataFrame,
    key: str = "id",
    summary: str = "summary",
    stop_words: Iterable[str] = ENGLISH,
) -> DataFrame:
    """Exact weight of each term in each document: tf * ln((N + 1) / (df + 1)).

    ``key`` is unique. A document's terms are counted in its row: its words
    are sorted and runs of equal words measured; stop words are left out of
    the terms, not of each text's words. The counts are written once;
    what is shuffled is one row per term and task, for the documents per term.
    """
    listed = F.sort_array(text.words(F.col(summary)))
    places = F.expr("filter(sequence(0, size(listed) - 1), i -> i = 0 OR listed[i] <> listed[i - 1])")
    runs = F.expr(
        "transform(starts, (s, j) -> struct(listed[s] AS term, coalesce(get(starts, j + 1), size(listed)) - s AS tf))"
    )
    terms = spool(
        df.select(key, listed.alias("listed"))
        .where(F.col("listed").isNotNull())
        .withColumn("starts", places)
        .select(key, F.explode(runs).alias("run"))
        .select(key, "run.term", F.col("run.tf").cast("long").alias("tf"))
        .where(text.not_stop_word(F.col("term"), stop_words)),
        "terms",
    )
    total = df.agg(F.count("*").alias("n")).scalar()
    weights = spool(
        terms.groupBy("term")
        .agg(F.count("*").alias("df"))
        .select("term", "df", F.log((total + F.lit(1)) / (F.col("df") + F.lit(1))).alias("idf")),
        "idf",
    )
    return lookup_join(terms, weights, ["term"], "inner").select(
        key, "term", "tf", "df", (F.col("tf") * F.col("idf")).alias("tfidf")
    )

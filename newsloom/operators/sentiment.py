"""Sentiment of a document: mean polarity of its words found in a lexicon."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.scoring import sentiment_label
from newsloom.functions.text import words
from newsloom.operators.entities import OUTER
from newsloom.operators.joins import lookup_join

# A small English lexicon of our own, polarity from -1 to 1, graded by hand for
# news texts. Give a larger one as a frame.
POLARITY = {
    "amazing": 0.6, "bad": -0.7, "best": 1.0, "better": 0.5, "boring": -1.0,
    "broken": -0.4, "clean": 0.4, "crash": -0.6, "danger": -0.5, "dangerous": -0.6,
    "dead": -0.2, "delay": -0.3, "delayed": -0.3, "difficult": -0.5, "excellent": 1.0,
    "exciting": 0.3, "fail": -0.5, "failed": -0.5, "failure": -0.3, "free": 0.4,
    "good": 0.7, "great": 0.8, "happy": 0.8, "hard": -0.3, "healthy": 0.5,
    "historic": 0.2, "important": 0.4, "impossible": -0.7, "innovative": 0.5, "loss": -0.3,
    "lost": -0.3, "love": 0.5, "new": 0.1, "nice": 0.6, "perfect": 1.0,
    "poor": -0.4, "powerful": 0.3, "problem": -0.3, "promising": 0.4, "risk": -0.2,
    "safe": 0.5, "special": 0.4, "strong": 0.4, "success": 0.3, "successful": 0.8,
    "successfully": 0.8, "terrible": -1.0, "useful": 0.3, "useless": -0.5, "weak": -0.4,
    "win": 0.8, "worst": -1.0, "worthless": -0.8, "wrong": -0.5,
}


# Polarities are added as whole billionths, so that the order does not matter.
_UNIT = 1_000_000_000


def default_lexicon(spark) -> DataFrame:
    return spark.createDataFrame(sorted(POLARITY.items()), "token string, polarity double")


def sentiment(
    df: DataFrame,
    lexicon: DataFrame | None = None,
    scorer=None,
    key: str = "id",
    summary: str = "summary",
) -> DataFrame:
    """Score and label of each document: columns id, sentiment_score, sentiment.

    Without ``scorer`` the score is the mean polarity of the words in the
    lexicon, 0 when there is none. Marks at a word's ends do not count. Words outside it are dropped before the
    shuffle, which carries one sum per document and task. ``scorer`` is a
    pandas UDF from text to float that takes the place of the lexicon.
    """
    if scorer is not None:
        return _labelled(
            df.select(F.col(key).alias("id"), scorer(F.coalesce(F.col(summary), F.lit(""))).alias("_score"))
        )
    lexicon = default_lexicon(df.sparkSession) if lexicon is None else lexicon
    units = F.round(F.min("polarity") * _UNIT).cast("long")
    unique = lexicon.groupBy("token").agg(units.alias("units"))
    tokens = df.select(F.col(key).alias("id"), F.explode(words(F.col(summary))).alias("token"))
    tokens = tokens.withColumn("token", F.btrim("token", F.lit(OUTER)))
    hits = lookup_join(tokens, unique, ["token"], "inner").select("id", "units")
    every = df.select(F.col(key).alias("id"), F.lit(None).cast("long").alias("units"))
    sums = every.unionByName(hits).groupBy("id").agg(F.sum("units").alias("sum"), F.count("units").alias("n"))
    return _labelled(sums.select("id", F.try_divide("sum", F.col("n") * _UNIT).alias("_score")))


def _labelled(scored: DataFrame) -> DataFrame:
    score: Column = F.coalesce(F.col("_score"), F.lit(0.0)).cast("float")
    return scored.select(
        "id", score.alias("sentiment_score"), sentiment_label(score).alias("sentiment")
    )

"""Score expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of reliability, sentiment and topic size.
RELIABILITY_WEIGHT = 0.5
SENTIMENT_WEIGHT = 0.3
TOPIC_WEIGHT = 0.2


def sentiment_label(score: Column) -> Column:
    return F.when(score > 0, "positive").when(score < 0, "negative").otherwise("neutral")


def importance(reliability: Column, sentiment: Column, topic_size: Column) -> Column:
    """Weighted sum. An unknown source or topic counts 0; a null sentiment gives null."""
    return (
        F.lit(RELIABILITY_WEIGHT) * F.coalesce(reliability, F.lit(0.0))
        + F.lit(SENTIMENT_WEIGHT) * sentiment
        + F.lit(TOPIC_WEIGHT) * F.log1p(F.coalesce(topic_size, F.lit(0)))
    )

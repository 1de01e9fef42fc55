"""Upserts, as functions from the present table and a batch to the new table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.operators.ranking import ranked


def one_per_key(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by its other columns. Copies meet first where they lie."""
    rest = [c for c in batch.columns if c not in keys]
    if not rest:
        return batch.distinct()
    return (
        batch.groupBy(*keys)
        .agg(F.min(F.struct(*rest)).alias("_kept"))
        .select(*[F.col(c) if c in keys else F.col(f"_kept.{c}").alias(c) for c in batch.columns])
    )


def upsert(
    table: DataFrame, batch: DataFrame, keys: Sequence[str], replace: Sequence[str]
) -> DataFrame:
    """New keys are added; for known keys only the ``replace`` columns are taken, nulls too.

    ``table`` has unique keys. Columns of ``table`` that ``batch`` lacks are
    null in new rows.
    """
    given = [c for c in table.columns if c in batch.columns and c not in keys]
    incoming = one_per_key(batch.select(*keys, *given), keys).select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in given], F.lit(True).alias("_in_batch")
    )
    merged = table.withColumn("_in_table", F.lit(True)).join(incoming, list(keys), "full_outer")

    def value(column: str):
        if column in keys or column not in given:
            return F.col(column)
        from_batch = F.col("_in_batch") if column in replace else F.col("_in_table").isNull()
        return F.when(from_batch, F.col(f"_new_{column}")).otherwise(F.col(column)).alias(column)

    return merged.select(*[value(c) for c in table.columns])


def insert_missing(table: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the rows with new keys; known keys keep their first row for ever."""
    new = one_per_key(batch, keys).join(table.select(*keys), list(keys), "left_anti")
    return table.unionByName(new)


def upsert_sources(table: DataFrame, batch: DataFrame) -> DataFrame:
    """Upsert a source profile by name: known sources take the new reliability only.

    New sources get the next ids, in the order of their names, without gaps.
    """
    incoming = batch.select(F.col("source_name").alias("name"), "url", "reliability_score")
    incoming = one_per_key(incoming.where(F.col("name").isNotNull()), ["name"])
    known = upsert(
        table,
        incoming.join(table.select("name"), "name", "left_semi"),
        ["name"],
        ["reliability_score"],
    )
    new = ranked(
        incoming.join(table.select("name"), "name", "left_anti"), [("name", "asc")], alias="_place", aggregated=True
    )
    last = table.agg(F.coalesce(F.max("source_id"), F.lit(0))).scalar()
    numbered = new.select(
        (last + F.col("_place")).alias("source_id"), "name", "url", "reliability_score"
    )
    return known.unionByName(numbered.select(*table.columns))


def upsert_topics(table: DataFrame, batch: DataFrame) -> DataFrame:
    return insert_missing(table, batch.select(*schemas.DIM_TOPIC.fieldNames()), ["topic_id"])


def upsert_facts(table: DataFrame, batch: DataFrame) -> DataFrame:
    return upsert(
        table, batch, ["article_id", "published_at"], ["sentiment_score", "importance_score"]
    )

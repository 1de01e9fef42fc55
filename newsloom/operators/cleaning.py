"""From delivered documents to one clean, deduplicated set."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newsloom import schemas
from newsloom.functions import text
from newsloom.functions.dates import utc_date
from newsloom.operators.joins import lookup_join
from newsloom.session import spool


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of ``schema``, cast to its types; a missing column is an error."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace nulls by column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def normalize(df: DataFrame, missing_id: int | None = None) -> DataFrame:
    """Raw records as delivered, to the RAW schema with tidy text.

    Missing text becomes "", a missing flag false, a missing list "[]". An id
    that is no number becomes ``missing_id``; the default leaves it null for
    the constraint checks, since one shared id would merge unrelated documents.
    """
    tidy = df.select(
        F.coalesce(F.col("id").try_cast("long"), F.lit(missing_id).cast("long")).alias("id"),
        text.one_line(F.col("title")).alias("title"),
        *[text.strip(F.col(c)).alias(c) for c in ("url", "image_url", "news_site")],
        text.quiet_quotes(text.squeeze(F.col("summary"))).alias("summary"),
        "published_at",
        "updated_at",
        F.col("featured").try_cast("boolean").alias("featured"),
        "launches",
        "events",
    )
    empty = ("title", "url", "image_url", "news_site", "summary", "published_at", "updated_at")
    defaults = dict.fromkeys(empty, "") | {"featured": False, "launches": "[]", "events": "[]"}
    return conform(fill_defaults(tidy, defaults), schemas.RAW)


def union_doc_types(batches: Mapping[str, DataFrame], schema: StructType = schemas.RAW) -> DataFrame:
    """All batches in one frame by column name, each row marked with its ``doc_type``."""
    parts = [
        conform(df, schema).withColumn("doc_type", F.lit(name)) for name, df in batches.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def clean(
    df: DataFrame,
    summary: str = "summary",
    dates: Sequence[str] = ("published_at", "updated_at"),
) -> DataFrame:
    """Summary on one line, trimmed, in lower case; dates as UTC days."""
    return df.withColumns(
        {
            summary: text.clean_summary(F.col(summary)),
            **{c: utc_date(F.col(c), df.schema[c].dataType) for c in dates},
        }
    )


def deduplicate(
    df: DataFrame,
    keys: Sequence[str] = ("id",),
    latest: Sequence[str] = ("updated_at",),
) -> DataFrame:
    """One row per key: the one with the greatest ``latest`` columns.

    Remaining ties go to the smallest other columns, so every run keeps the
    same row. The keys are counted first, without the other columns; rows whose
    key occurs once pass through, the others are put in order by key.
    """
    counts = df.select(*keys).groupBy(*keys).agg(F.count("*").alias("_copies"))
    repeated = spool(counts.where("_copies > 1").select(*keys), "copies")
    single = lookup_join(df, repeated, keys, "left_anti", null_safe=True)
    copied = lookup_join(df, repeated, keys, "left_semi", null_safe=True)
    return single.unionByName(_best_rows(copied, keys, latest))


def _best_rows(df: DataFrame, keys: Sequence[str], latest: Sequence[str]) -> DataFrame:
    """Spark limits each key to one row per task before the shuffle, so a key
    with very many copies does not pile up in one task."""
    order: list[Column] = [F.col(c).desc_nulls_last() for c in latest]
    order += [F.col(c).asc_nulls_last() for c in df.columns if c not in (*keys, *latest)]
    best = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_copy", F.row_number().over(best)).where("_copy = 1").drop("_copy")

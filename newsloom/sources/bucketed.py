"""Parquet folders cut into buckets by a key, so that tables with the same buckets join without a shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def write_bucketed(df: DataFrame, path: str, by: str, buckets: int) -> DataFrame:
    """Write ``df`` to ``path`` in ``buckets`` buckets of ``by``, each one file, and read it back as such.

    Rows are shuffled here, once; where ``df`` comes out of a shuffle by the
    same key into as many parts, not even that. Rows with one key share a
    bucket, so the key should be nearly unique. The folder is plain Parquet to
    any other reader.
    """
    name = _unused_name()
    (
        df.repartition(buckets, by)
        .write.mode("overwrite")
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, by)
        .sortBy(by)
        .saveAsTable(name)
    )
    return _taken(df.sparkSession, name)


def read_bucketed(spark: SparkSession, path: str, schema: StructType, by: str, buckets: int) -> DataFrame:
    """A folder that write_bucketed wrote with the same ``by`` and ``buckets``, in any session."""
    name = _unused_name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (path '{path}')"
        f" CLUSTERED BY (`{by}`) SORTED BY (`{by}`) INTO {int(buckets)} BUCKETS"
    )
    return _taken(spark, name)


def _taken(spark: SparkSession, name: str) -> DataFrame:
    """The table's frame, without the entry in the catalog: the frame knows its files and buckets itself."""
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return found


def _unused_name() -> str:
    return f"bucketed_{uuid.uuid4().hex}"

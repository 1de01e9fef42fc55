"""Paths on any file system Spark can reach."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    system, hadoop = _open(spark, path)
    return system.exists(hadoop)


def existing(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    return [p for p in paths if exists(spark, p)]


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none when there is no such folder."""
    system, hadoop = _open(spark, path)
    if not system.exists(hadoop):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(hadoop))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder."""
    system, hadoop = _open(spark, path)
    system.delete(hadoop, True)

"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from newsloom.operators.joins import measured_bytes


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_partitioned(df: DataFrame, path: str, by: str, mode: str = "static") -> str:
    """Parquet in one folder per value of ``by``, files of even size.

    The rebalance gathers small groups into few files and cuts a large one
    among tasks. ``mode`` "static" replaces the whole folder, "dynamic" only
    the groups present in ``df``.
    """
    (
        df.hint("rebalance", by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(by)
        .parquet(path)
    )
    return path


def write_csv(df: DataFrame, path: str, parts: int | None = None, file_bytes: int | None = None) -> str:
    """CSV with a header, in as many parts as ``df`` has or in ``parts`` as the caller says.

    Values come back as they are: blanks at their ends, quotes, commas and
    line breaks of every kind. With ``file_bytes`` there are more than ``parts``
    where a file would hold more values than that, measured over ``df``, so
    that no task writes a whole large table.
    """
    if file_bytes is not None:
        parts = max(parts or 1, -(-measured_bytes(df) // file_bytes))
        _csv((df.coalesce(parts) if df.rdd.getNumPartitions() > parts else df.repartition(parts)).write, path)
        return path
    _csv((df if parts is None else df.repartition(parts)).write, path)
    return path


def write_raw(df: DataFrame, path: str) -> str:
    """Delivered records as CSV. Without records nothing is written, the path is still given."""
    if not df.isEmpty():
        write_csv(df, path)
    return path


def _csv(writer, path: str) -> None:
    (
        writer.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("quoteAll", True)
        .option("lineSep", "\n")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )

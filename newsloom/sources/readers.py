"""Batch sources. Schemas are given, never inferred."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newsloom import schemas
from newsloom.sources.csv_split import read_csv_split
from newsloom.sources.files import existing

# How this package reads CSV; a stream takes the same.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "lineSep": "\n",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "maxCharsPerColumn": -1,
}


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType = schemas.RAW,
    multi_line: bool = True,
    split: bool = False,
) -> DataFrame:
    """CSV with a header and doubled quotes; a folder is read whole. Empty text reads as null.

    Fields may hold line breaks, so a file is read by one task; this package
    writes a folder of many files. With ``split`` large files are read by many
    tasks with the same result, in three passes (see csv_split for what quotes
    may stand for). Without ``multi_line`` a file is split among tasks, and a
    line break inside a field ends the record.
    """
    if split:
        return read_csv_split(spark, paths, schema, CSV_OPTIONS)
    return spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=multi_line).csv(paths)


def read_docs(
    spark: SparkSession,
    paths: Iterable[str],
    schema: StructType = schemas.RAW,
    multi_line: bool = True,
    split: bool = False,
) -> DataFrame:
    """All of ``paths`` that exist; an empty frame when none does."""
    present = existing(spark, paths)
    if not present:
        return spark.createDataFrame([], schema)
    return read_csv(spark, present, schema, multi_line, split)


def read_doc_types(
    spark: SparkSession, paths: Mapping[str, str], multi_line: bool = True, split: bool = False
) -> dict[str, DataFrame]:
    """One frame per document type; types without a file are left out."""
    present = set(existing(spark, paths.values()))
    return {
        name: read_csv(spark, path, multi_line=multi_line, split=split)
        for name, path in paths.items()
        if path in present
    }


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def read_rows(
    spark: SparkSession, rows: Sequence[Mapping], schema: StructType = schemas.RAW
) -> DataFrame:
    """Records held in memory; ids and flags given as text are cast, missing keys are null."""
    text = ", ".join(f"`{f.name}` string" for f in schema.fields)
    values = [
        tuple(None if row.get(n) is None else str(row[n]) for n in schema.fieldNames())
        for row in rows
    ]
    frame = spark.createDataFrame(values, text)
    return frame.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def read_pages(spark: SparkSession, paths: str | Sequence[str], multi_line: bool = False) -> DataFrame:
    """Records of stored service pages, one JSON page per line (or per file if ``multi_line``)."""
    pages = spark.read.schema(schemas.PAGE).option("multiLine", multi_line).json(paths)
    return page_records(pages)


def page_records(pages: DataFrame) -> DataFrame:
    """One row per record; a page without results has none."""
    return pages.select(F.explode("results").alias("record")).select("record.*")


def since(df: DataFrame, day: str | None, column: str = "published_at") -> DataFrame:
    """Rows on or after ``day``; all rows when it is None."""
    if day is None:
        return df
    return df.where(F.col(column) >= F.lit(day).cast(df.schema[column].dataType))

"""One CSV file with line breaks inside its fields, read by many tasks.

Whether a byte lies inside a quoted field follows from the number of quotes
before it: odd is inside. A first pass counts the quotes of each split and
adds up the splits before it; a second one then knows where its first record
begins and keeps the pieces of records that reach over an end of a split, which
are brought together. What lies in one split is read last and never leaves its
task. So a file is read three times, and only pieces are ever written.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newsloom.operators.joins import small_enough
from newsloom.session import spool

WHOLE, BEFORE, AFTER = 0, 1, 2  # a record; the end of one begun in an earlier split; the beginning of one that goes on
_PIECE = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("header", pa.bool_()), ("record", pa.string())])
_PIECES = "block long, kind int, header boolean, record string"


def csv_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The records (column ``record``) of CSV files with a header, as text with their quotes and line breaks.

    Files are split among tasks as Spark splits text. Quotes may stand only
    around a field and, doubled, inside a quoted field. Blank lines between
    records are no records. A last field that is never closed ends with the
    file.
    """
    lines = spark.read.text(paths, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    lines = lines.withColumn("block", F.xxhash64("file", "start"))
    blocks = spool(_parities(lines), "csv-blocks")
    if blocks.select("block").distinct().count() < blocks.count():
        raise ValueError("two splits have one number; read with multi_line=True instead")
    starts = blocks.select("block", "odd")
    told = lines.select("value", "block", (F.col("start") == 0).alias("first"))
    if small_enough(starts):
        told = told.join(F.broadcast(starts), "block")  # lines stay in their task, in their order
    else:
        told = told.withColumn("line", F.monotonically_increasing_id()).join(starts, "block")
        told = told.repartition("block").sortWithinPartitions("block", "line")
    told = told.select("value", "block", "odd", "first")
    whole = told.mapInArrow(_assembler(pieces=False), _PIECES)
    pieces = spool(told.mapInArrow(_assembler(pieces=True), _PIECES), "csv-pieces")
    return whole.unionByName(_joined(pieces, blocks)).where(~F.col("header")).select("record")


def read_csv_split(spark: SparkSession, paths: str | Sequence[str], schema: StructType, options: dict) -> DataFrame:
    """CSV files with line breaks in fields, as csv_records finds the records, parsed with ``options``."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv("record", columns, {**options, "multiLine": "true"})
    return csv_records(spark, paths).select(parsed.alias("row")).select("row.*")


def _parities(lines: DataFrame) -> DataFrame:
    """For each split whether an odd number of quotes lies before it in its file."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    per_block = lines.groupBy("file", "start", "block").agg(F.sum(quotes).alias("quotes"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("quotes").over(earlier), F.lit(0))
    return per_block.select("file", "start", "block", (before % 2 == 1).alias("odd"))


def _joined(pieces: DataFrame, blocks: DataFrame) -> DataFrame:
    """The records that reach over splits; the pieces' order is found without their text."""
    placed = pieces.select("block", "kind").join(blocks.select("block", "file", "start"), "block")
    order = Window.partitionBy("file").orderBy("start", "kind")
    owners = placed.withColumn("owner", F.count_if(F.col("kind") == AFTER).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    found = F.sort_array(F.collect_list(F.struct("start", "kind", "record")))
    return (
        pieces.join(owners, ["block", "kind"])
        .groupBy("file", "owner")
        .agg(F.array_join(found["record"], "\n").alias("record"), F.bool_or("header").alias("header"))
        .select(F.lit(None).cast("long").alias("block"), F.lit(WHOLE).alias("kind"), "header", "record")
    )


def _assembler(pieces: bool):
    """Lines to pieces of records, or to whole records."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _assemble(stream):
            if pieces:
                rows = rows.filter(pc.not_equal(rows.column(1), WHOLE))
            if rows.num_rows and (pieces or rows.column(1)[0].as_py() == WHOLE):
                yield rows

    return run


def _assemble(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines to records and pieces. The lines of a split follow each other."""
    block = open_lines = None  # the split, and the lines of the record that is not closed yet
    kind, header, inside = WHOLE, False, False

    def rest() -> Iterator[pa.RecordBatch]:
        """What is left open at the end of a split."""
        if open_lines is not None:
            closed = AFTER if kind == WHOLE else BEFORE
            yield _rows(block, [closed], [header], ["\n".join(open_lines)])

    for batch in stream:
        blocks = batch.column(1).to_numpy()
        cuts = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])) if len(blocks) else []
        for low, high in zip(cuts, [*cuts[1:], len(blocks)]):
            lines = batch.column(0).slice(low, high - low)
            if blocks[low] != block:
                yield from rest()
                block, inside = int(blocks[low]), batch.column(2)[low].as_py()
                kind, header, at_top = BEFORE, False, batch.column(3)[low].as_py()
                open_lines = [] if inside else None
            else:
                at_top = False
            quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
            after = (int(inside) + np.cumsum(quotes)) % 2 == 1  # inside a field at the end of each line
            begins = np.flatnonzero(~np.append(inside, after[:-1]))
            inside = bool(after[-1])
            if open_lines is not None:
                until = int(begins[0]) if len(begins) else len(lines)
                open_lines += lines.slice(0, until).to_pylist()
                if len(begins) or not inside:
                    yield _rows(block, [kind], [header], ["\n".join(open_lines)])
                    open_lines = None
            if not len(begins):
                continue
            ends = np.append(begins[1:], len(lines))
            if inside:  # the last record goes on
                open_lines, kind = lines.slice(int(begins[-1])).to_pylist(), WHOLE
                header = at_top and len(begins) == 1
                begins, ends = begins[:-1], ends[:-1]
            if not len(begins):
                continue
            heads = np.zeros(len(begins), dtype=bool)
            heads[0] = at_top
            single = ends - begins == 1
            filled = np.asarray(pc.not_equal(lines.take(pa.array(begins[single])), "")) if single.any() else np.zeros(0, bool)
            yield _rows(block, None, heads[single][filled], lines.take(pa.array(begins[single][filled])))
            several = ["\n".join(lines.slice(int(a), int(b - a)).to_pylist()) for a, b in zip(begins[~single], ends[~single])]
            yield _rows(block, None, heads[~single], several)
    yield from rest()


def _rows(block: int, kinds, headers, records) -> pa.RecordBatch:
    kinds = np.full(len(headers), WHOLE) if kinds is None else kinds
    columns = [np.full(len(headers), block), kinds, headers, records]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECE)], schema=_PIECE)

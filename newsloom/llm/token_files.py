"""Token ids in ORC files: ascending ids, Bloom filters and row indexes on the document id."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.common import batches, whole_text
from newsloom.llm.tokens import encoder, tokenizer_path
from newsloom.session import scratch_path

END = 0
#: Rows of an ORC row index entry; readers skip so many rows at a time.
INDEX_STRIDE = 1000
STRIPE_BYTES = 16 << 20


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    files: int | None = None,
    end: int = END,
) -> None:
    """Encode every whole text and write one row per document in ascending id order.

    Rows are ``doc_id``, ``start`` (ids of all earlier documents of the same
    file) and ``ids`` (the text's ids, then ``end``). ORC keeps integers
    run-length encoded; each stripe can be read by itself, its row index has
    the least and greatest id of every 1000 rows, and a Bloom filter tells
    which ids a stripe cannot hold. There are as many ``files`` as the caller
    says, or one for each range of ids that the session's partition size gives.
    A null text is empty, a null id sorts
    first, rows with equal ids are ordered by text and all kept. An empty
    table writes files without rows.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    ranges = rows.repartitionByRange("doc_id") if files is None else rows.repartitionByRange(files, "doc_id")
    rows = ranges.sortWithinPartitions("doc_id", "text")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def encode(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = 0
        stop = np.asarray([end], dtype="<u4").tobytes()
        for table in batches(stream, "text", 4 << 20):
            encoded = [x + stop for x in encoder(tokenizer, keeps_space=True).encode(table["text"].to_pylist())]
            sizes = np.asarray([len(x) // 4 for x in encoded], dtype=np.int64)
            ends = np.cumsum(sizes)
            values = np.frombuffer(b"".join(encoded), dtype="<u4").astype(np.int32)
            offsets = pa.array(np.append(0, ends).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    table["doc_id"].combine_chunks(),
                    pa.array(start + ends - sizes),
                    pa.ListArray.from_arrays(offsets, pa.array(values)),
                ],
                schema=schema,
            )
            start += int(ends[-1])

    (
        rows.mapInArrow(encode, "doc_id long, start long, ids array<int>")
        .write.option("compression", "snappy")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", str(INDEX_STRIDE))
        .option("orc.stripe.size", str(STRIPE_BYTES))
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str, ids: tuple[int, int] | None = None) -> DataFrame:
    """The rows of the files; with ``ids``, the documents from the first to the last id.

    The bounds are pushed to the scan: stripes and row groups whose ids lie
    outside are not read, and a single id is looked up in the Bloom filters.
    """
    rows = spark.read.schema("doc_id long, start long, ids array<int>").orc(path)
    if ids is None:
        return rows
    low, high = ids
    return rows.where(F.col("doc_id") == low if low == high else F.col("doc_id").between(low, high))


def token_positions(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start among all files, n_tokens, ids_crc32.

    A file's rows already have their place in the file; only one row per file
    is put in order to add what the files before it hold.
    """
    rows = read_tokens(spark, path).select("doc_id", "start", "ids", F.col("_metadata.file_name").alias("file"))

    def measure(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            lists = batch.column(2)
            offsets = lists.offsets.to_numpy()
            data = lists.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes()
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64()), batch.column(3)],
                names=["doc_id", "start", "n_tokens", "ids_crc32", "file"],
            )

    sizes = rows.groupBy("file").agg(
        F.sum(F.size("ids")).alias("tokens"), F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("first")
    )
    return (
        rows.mapInArrow(measure, "doc_id long, start long, n_tokens long, ids_crc32 long, file string")
        .join(_before(sizes), "file")
        .select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
    )


def _before(sizes: DataFrame) -> DataFrame:
    """Tokens of all files before each; one row per file."""
    from pyspark.sql import Window

    earlier = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("file", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("before"))


def token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token files and measured from them."""
    path = scratch_path(spark, "tokens")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, tokenizer_path("byte_bpe_50k.json"))
    return token_positions(spark, path)

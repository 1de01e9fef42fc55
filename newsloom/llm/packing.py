"""Best-fit packing by exact complements: pieces of documents into sequences of a fixed length."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.llm.common import batches, spool, whole_text
from newsloom.llm.tokens import encoder, tokenizer_path

LENGTH = 2048
#: Pieces that are numbered in one task.
RANKED_ROWS = 50_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = 0, id_column="doc_id", text_column="text") -> DataFrame:
    """Every document's ids (and ``end``) cut into pieces of ``length``; only the last may be shorter."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stop = np.asarray([end], dtype="<u4").tobytes()
        for table in batches(stream, "text", 4 << 20):
            out: list[list] = [[], [], [], [], []]
            encoded = encoder(tokenizer, keeps_space=False).encode(table["text"].to_pylist())
            for doc, ids in zip(table["doc_id"].to_pylist(), encoded):
                ids += stop
                for piece, start in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[start : start + 4 * length]
                    for column, value in zip(out, (doc, piece, start // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return rows.mapInArrow(cut, PIECES)


def plan(counts: dict[int, int], length: int = LENGTH) -> list[tuple[list[int], int]]:
    """Patterns of piece lengths that fill sequences, and how often each is used.

    The longest piece left opens a sequence. Its gap is looked up among the
    lengths, the sums of two and the sums of three lengths that are left: a
    hit fills the sequence exactly and is used as often as the counts allow.
    What has no such complement is filled best-fit, the longest piece that
    fits first. Each use exhausts a length (or leaves fewer than a pattern
    needs), so there are a few thousand patterns however many pieces there are.
    """
    left = np.zeros(length + 1, dtype=np.int64)
    for size, n in counts.items():
        left[size] = n
    patterns: list[tuple[list[int], int]] = []

    def use(pattern: list[int]) -> None:
        need = Counter(pattern)
        times = min(int(left[size]) // n for size, n in need.items())
        for size, n in need.items():
            left[size] -= n * times
        patterns.append((pattern, times))

    for size in range(length, 0, -1):
        while left[size]:
            gap = length - size
            filling = _complement(left, size, gap)
            if filling is None:
                filling = _best_fit(left, size, gap)
            use([size, *filling])
    return patterns


def _free(left: np.ndarray, taken: list[int]) -> np.ndarray:
    free = left.copy()
    for size in taken:
        free[size] -= 1
    return free


def _pair(free: np.ndarray, gap: int) -> list[int] | None:
    """Two lengths with the sum ``gap``, the longer one as long as can be."""
    longer = np.arange(gap - 1, (gap - 1) // 2, -1)
    good = (free[longer] > 0) & (free[gap - longer] > 0) & ((longer * 2 != gap) | (free[longer] > 1))
    at = np.flatnonzero(good)
    return [int(longer[at[0]]), int(gap - longer[at[0]])] if len(at) else None


def _complement(left: np.ndarray, size: int, gap: int) -> list[int] | None:
    """One, two or three available lengths that sum to the gap."""
    if gap == 0:
        return []
    free = _free(left, [size])
    if free[gap] > 0:
        return [gap]
    pair = _pair(free, gap)
    if pair:
        return pair
    for first in range(gap - 2, (gap + 2) // 3 - 1, -1):
        if free[first] > 0:
            rest = _pair(_free(free, [first]), gap - first)
            if rest:
                return [first, *rest]
    return None


def _best_fit(left: np.ndarray, size: int, gap: int) -> list[int]:
    """The longest piece that fits, again and again."""
    free, filling = _free(left, [size]), []
    while gap:
        fits = np.flatnonzero(free[1 : gap + 1])
        if not len(fits):
            break
        best = int(fits[-1]) + 1
        free[best] -= 1
        filling.append(best)
        gap -= best
    return filling


def _slots(patterns: list[tuple[list[int], int]], length: int) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, in the order of ranks: last rank of a run, its first rank, sequence and offset."""
    taken = np.zeros(length + 1, dtype=np.int64)
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for size in pattern:
            low = int(taken[size])
            taken[size] += times
            runs.setdefault(size, []).append((low + times, low, sequence, offset))
            offset += size
        sequence += times
    return {size: tuple(np.asarray(x, dtype=np.int64) for x in zip(*own)) for size, own in runs.items()}


def _ranked(rows: DataFrame) -> DataFrame:
    """A number from 0 for each piece among those of its length.

    Pieces of a length are dealt by a hash into parts of bounded size, so a
    length that most pieces share is numbered by many tasks.
    """
    parts = max(1, -(-rows.count() // RANKED_ROWS))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("length", "part").count()
        .select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    )
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    return (
        dealt.withColumn("rank", F.row_number().over(within) - 1)
        .join(starts, ["length", "part"])
        .withColumn("rank", F.col("rank") + F.col("before"))
        .drop("part", "before")
    )


def pack(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """Place pieces (doc_id, piece, start, length, ids_crc32) into as few sequences as it can.

    Adds ``sequence_id`` and ``offset``; a sequence is filled from 0 without
    gaps. The driver sees how many pieces each of the ``length`` lengths has,
    nothing else; the patterns it returns are bounded by that number too.
    Pieces of one length are interchangeable, so a piece finds its place by
    its number among them. No pieces give no rows; repeated rows are pieces
    of their own.
    """
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    slots = _slots(plan(counts, length), length)

    def place(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            sizes = batch.column(3).to_numpy()
            ranks = batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                last, low, first, at = slots[int(size)]
                run = np.searchsorted(last, ranks[own], side="right")
                sequence[own] = first[run] + ranks[own] - low[run]
                offset[own] = at[run]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(5)), pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    columns = ("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return _ranked(rows).select(*columns).mapInArrow(place, f"{PIECES}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """All documents in sequences of at most ``length`` tokens; see pieces and pack.

    A null text is empty and still is a piece of one token, the end. Texts of
    any length are encoded whole. Null ids are kept. Other columns are left out.
    """
    return pack(spool(pieces(docs, tokenizer, length), "pieces"), length)


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path("word_bpe_49k.json"))

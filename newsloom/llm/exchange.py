"""Entries of a batch sent to buckets by hash, and answers brought back to the batch.

A task that reads documents packs what it asks about a hash into one row per
bucket (``bucket``, ``kind``, ``batch``, ``payload``), so that a shuffle moves
a few bytes an entry. The batch's own row (kind OWN) carries its document
table; it travels with the others and meets the answers again. A batch's id is
a hash of its documents and place: a task that runs again gives the same rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame

from newsloom.llm.common import total_chars

ROW = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("batch", pa.int64()), ("payload", pa.binary())])
ROWS = "bucket int, kind int, batch long, payload binary"
OWN = 9
#: Characters of text that a bucket answers for, and that a batch holds.
BUCKET_CHARS = 12_000_000
BATCH_BYTES = 8 << 20


def bucket_count(docs: DataFrame, text: str = "text") -> int:
    return max(1, -(-total_chars(docs, text) // BUCKET_CHARS))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each hash, from its upper half."""
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.uint32)


def grouped(buckets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that occurs and the entries in it, in their order."""
    if not len(buckets):
        return
    kind = np.uint16 if buckets.max() < 1 << 16 else np.uint32
    order = np.argsort(buckets.astype(kind), kind="stable")
    own = buckets[order]
    cuts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    for low, high in zip(cuts, np.append(cuts[1:], len(own))):
        yield int(own[low]), order[low:high]


def batch_id(keys: np.ndarray, number: int) -> int:
    """Names a batch by its documents, its task's part of the input and its number there."""
    context = TaskContext.get()
    part = context.partitionId() if context else 0
    return xxhash.xxh64_intdigest(keys.tobytes() + f"{part}:{number}".encode()) - 2**63


def join_bytes(*arrays: np.ndarray) -> bytes:
    """Arrays of one length each preceded by its number of bytes."""
    return b"".join(len(a.tobytes()).to_bytes(8, "little") + a.tobytes() for a in arrays)


def split_bytes(payload: bytes, *kinds) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        size = int.from_bytes(payload[at : at + 8], "little")
        out.append(np.frombuffer(payload, dtype=kind, count=size // np.dtype(kind).itemsize, offset=at + 8))
        at += 8 + size
    return out


def pack_refs(refs: np.ndarray) -> np.ndarray:
    """Rising numbers as bytes: differences in planes, which compress well."""
    steps = np.diff(refs.astype(np.uint32), prepend=np.uint32(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).reshape(-1)


def unpack_refs(planes: np.ndarray) -> np.ndarray:
    steps = np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).reshape(-1)
    return np.cumsum(steps, dtype=np.uint32)


def own_row(batch: int, buckets: int, keys, copies, first, extra: bytes = b"") -> tuple:
    """The batch's document table: keys, copies, index of each document's first entry, and more bytes."""
    table = join_bytes(keys, copies, np.asarray(first, dtype=np.uint32), np.frombuffer(extra, dtype=np.uint8))
    return int(batch % buckets), OWN, batch, zlib.compress(table, 1)


def read_own(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    keys, copies, first, extra = split_bytes(zlib.decompress(payload), np.int64, np.int64, np.uint32, np.uint8)
    return keys, copies, first, extra.tobytes()


def rows_of(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([], [], [], [])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ROW)], schema=ROW)


def _runs(stream: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, Iterator]]:
    """Groups of rows (kind, batch, payload) that follow each other with one value of ``column``."""
    import itertools

    def rows():
        for batch in stream:
            names = batch.schema.names
            columns = {n: batch.column(i) for i, n in enumerate(names)}
            for i in range(batch.num_rows):
                yield columns[column][i].as_py(), columns["kind"][i].as_py(), columns["batch"][i].as_py(), columns["payload"][i].as_py()

    for value, group in itertools.groupby(rows(), key=lambda r: r[0]):
        yield value, (r[1:] for r in group)


def answer(asked: DataFrame, buckets: int, reply: Callable[[Iterator], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """Bring the rows of each bucket together, smaller kinds first, and put ``reply``'s rows with their batches.

    ``reply`` gets an iterator of (kind, batch, payload) of one bucket and
    yields (batch, payload). Returns (kind, batch, payload) with the batches'
    own rows first, sorted by batch.
    """

    def per_bucket(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, group in _runs(stream, "bucket"):
            through: list[tuple] = []

            def asked_rows():
                for kind, batch, payload in group:
                    if kind == OWN:
                        through.append((bucket, OWN, batch, payload))
                    else:
                        yield kind, batch, payload

            held, size = [], 0
            for batch, payload in reply(asked_rows()):
                held.append((bucket, OWN + 1, batch, payload))
                size += len(payload)
                if size > 4 << 20:
                    yield rows_of(held)
                    held, size = [], 0
            for _, *row in ((0, *r) for r in group):  # what reply has not read
                if row[0] == OWN:
                    through.append((bucket, *row))
            yield rows_of(held + through)

    return (
        asked.repartition(buckets, "bucket")
        .sortWithinPartitions("bucket", "kind")
        .mapInArrow(per_bucket, ROWS)
        .repartition("batch")
        .sortWithinPartitions("batch", "kind")
    )


def per_batch(answered: DataFrame, finish: Callable[[list, list[bytes]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``finish`` gets each batch's own table (see read_own) and the payloads that answer it."""

    def collect(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in _runs(stream, "batch"):
            own, replies = None, []
            for kind, _, payload in group:
                if kind == OWN:
                    own = read_own(payload)
                else:
                    replies.append(payload)
            yield from finish(own, replies)

    return answered.mapInArrow(collect, schema)

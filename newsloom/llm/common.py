"""Word hashing in numpy and small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import spool

__all__ = [
    "spool",
    "NO_ID",
    "whole_text",
    "doc_key",
    "key_to_id",
    "total_chars",
    "batches",
    "Words",
    "hash_words",
    "rolling",
    "mix",
]

#: Stands for a null id while ids are packed as 64-bit integers; sorts first as nulls do.
NO_ID = -(2**63)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes with A to Z in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_random = np.random.default_rng(20240917)
_BYTE = _random.integers(0, 2**64, 256, dtype=np.uint64)
_BYTE[_SPACE] = 0
_PLACES = 1 << 16
_PLACE = _random.integers(0, 2**64, _PLACES, dtype=np.uint64) | np.uint64(1)


def whole_text(column: str = "text"):
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def doc_key(column: str = "doc_id"):
    """The id as a long that is never null."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def key_to_id(column: str = "key"):
    """The id of a key of doc_key."""
    return F.when(F.col(column) != F.lit(NO_ID), F.col(column))


def is_space(data: np.ndarray) -> np.ndarray:
    """Which bytes separate words."""
    return _SPACE[data]


def total_chars(df: DataFrame, column: str = "text") -> int:
    """Characters of all texts, to choose how many parts the work is cut into."""
    return df.agg(F.coalesce(F.sum(F.length(column)), F.lit(0))).first()[0]


#: Texts of a batch at most: what is held for a text besides its bytes stays bounded for very short ones.
BATCH_ROWS = 20_000


def batches(stream: Iterator[pa.RecordBatch], text: str, most: int, rows: int = BATCH_ROWS) -> Iterator[pa.Table]:
    """Record batches put together, or cut, until each holds about ``most`` bytes of text, or ``rows`` rows.

    A single text longer than that is a batch by itself.
    """
    held, size, count = [], 0, 0
    for batch in stream:
        lengths = np.diff(_offsets(batch.column(batch.schema.get_field_index(text))))
        start = 0
        for row, length in enumerate(lengths):
            if (size and size + length > most) or count >= rows:
                if row > start:
                    held.append(batch.slice(start, row - start))
                yield pa.Table.from_batches(held)
                held, size, count, start = [], 0, 0, row
            size += int(length)
            count += 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _offsets(array: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type) else np.int32
    if not len(array):
        return np.zeros(1, dtype=np.int64)
    return np.frombuffer(array.buffers()[1], dtype=kind, count=len(array) + array.offset + 1)[array.offset :].astype(np.int64)


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each text starts (one more than texts)."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], type=column.type)
    offsets = _offsets(array)
    if not len(array) or array.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), offsets - offsets[0]
    data = np.frombuffer(array.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


class Words:
    """The words of a batch of texts: hash, document, and first and last byte of each.

    ``first`` has for each document the index of its first word, and one more.
    """

    def __init__(self, data, offsets, starts, ends, hashes, first):
        self.data, self.offsets, self.starts, self.ends = data, offsets, starts, ends
        self.hashes, self.first = hashes, first

    @property
    def docs(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word; no word reaches over two texts."""
    inside = ~_SPACE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < len(data)]
    opens[cuts] = inside[cuts]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    closes[cuts[cuts > 0] - 1] = inside[cuts[cuts > 0] - 1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def hash_words(column, lower: bool = False) -> Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of each text with a 64-bit hash of their bytes."""
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    starts, ends = word_spans(data, offsets)
    hashes = np.zeros(len(starts), dtype=np.uint64)
    step = 1 << 17  # words at a time, so that the products fit in the cache
    for low in range(0, len(starts), step):
        high = min(low + step, len(starts))
        own, until = starts[low:high], ends[low:high]
        part = data[own[0] : until[-1]]
        lengths = until - own
        gaps = np.append(own[1:], until[-1]) - own
        place = np.arange(len(part)) - np.repeat(own - own[0], gaps)
        inside = place < np.repeat(lengths, gaps)
        values = np.where(inside, _BYTE[part], np.uint64(0)) * _PLACE[place & (_PLACES - 1)]
        hashes[low:high] = np.add.reduceat(values, own - own[0]) + lengths.astype(np.uint64)
    first = np.searchsorted(starts, offsets)
    return Words(data, offsets, starts, ends, mix(hashes), first)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def rolling(hashes: np.ndarray, width: int, factor: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """The hash of each ``width`` consecutive words; entry i is of words i to i + width - 1.

    Windows that reach over two documents are in it too; the caller leaves them out.
    """
    if len(hashes) < width:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        power, done, size = np.uint64(factor), None, 0
        block, block_size, block_power = hashes, 1, power
        left = width
        while left:
            if left & 1:
                if done is None:
                    done, size = block, block_size
                else:
                    n = min(len(done), len(block) - size)
                    done = done[:n] * block_power + block[size : size + n]
                    size += block_size
            left >>= 1
            if left:
                n = len(block) - block_size
                block = block[:n] * block_power + block[block_size:]
                block_size, block_power = block_size * 2, block_power * block_power
        return mix(done)

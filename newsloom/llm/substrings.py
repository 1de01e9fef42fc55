"""Substring dedup: words covered by a 20-word window that also starts earlier are removed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.common import batches, doc_key, hash_words, key_to_id, rolling, spool, whole_text
from newsloom.llm.exchange import (
    BATCH_BYTES, ROWS, answer, batch_id, bucket_count, bucket_of, grouped, join_bytes, own_row, pack_refs, per_batch,
    rows_of, split_bytes, unpack_refs,
)

WINDOW = 20
#: Words of a reference block; each window holds a whole one of any document it occurs in.
BLOCK = WINDOW // 2
_BLOCKS, _PROBES = 0, 1
_LOW = np.uint64(0xFFFFFFFF)
POSITIONS = "key long, copy long, positions binary"


def _keyed(docs: DataFrame) -> DataFrame:
    """key and copy name a text: rows with equal ids and texts are one document."""
    return docs.select(doc_key().alias("key"), F.xxhash64(whole_text()).alias("copy"), whole_text().alias("text"))


def _ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return table["key"].to_numpy(), table["copy"].to_numpy()


def anchor_hits(rows: DataFrame, buckets: int) -> DataFrame:
    """For each text the words where a block of another place begins: key, copy, positions.

    Every text is cut into reference blocks of 10 words, which are the index;
    every window of 10 words probes it. What occurs twice in a batch is a hit
    without asking, so a passage that very many texts share is asked about
    once a batch at most, and not by each text. A window of 20 words that
    occurs elsewhere holds a whole reference block of the other place, so it
    holds a hit.
    """

    def ask(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in enumerate(batches(stream, "text", BATCH_BYTES)):
            keys, copies = _ids(table)
            batch = batch_id(keys, number)
            words = hash_words(table["text"])
            docs, sizes = words.docs, np.diff(words.first)
            windows = rolling(words.hashes, BLOCK)
            n = len(windows)
            at = np.flatnonzero((docs[:n] == docs[BLOCK - 1 :][:n]) & (sizes[docs[:n]] >= WINDOW)) if n else np.zeros(0, int)
            hashes = windows[at]
            order = np.argsort(hashes)
            same = hashes[order][1:] == hashes[order][:-1]
            twice = np.zeros(len(at), dtype=bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            aligned = (at - words.first[docs[at]]) % BLOCK == 0
            out = [own_row(batch, buckets, keys, copies, words.first, pack_refs(at[twice]).tobytes())]
            in_bucket = bucket_of(hashes, buckets)
            low = (hashes & _LOW).astype(np.uint32)

            single = np.flatnonzero(aligned & ~twice)
            several = np.flatnonzero(aligned & twice)
            several = several[np.unique(hashes[several], return_index=True)[1]]
            more = {b: several[own] for b, own in grouped(in_bucket[several])}
            none = np.zeros(0, dtype=int)
            once = {b: single[own] for b, own in grouped(in_bucket[single])}
            for bucket in sorted({*once, *more}):
                own, others = once.get(bucket, none), more.get(bucket, none)
                out.append((bucket, _BLOCKS, batch, join_bytes(low[own], pack_refs(at[own]), low[others])))
            probes = np.flatnonzero(~aligned & ~twice)
            for bucket, own in grouped(in_bucket[probes]):
                own = probes[own]
                out.append((bucket, _PROBES, batch, join_bytes(low[own], pack_refs(at[own]))))
            yield rows_of(out)

    def reply(rows: Iterator[tuple[int, int, bytes]]) -> Iterator[tuple[int, bytes]]:
        index, blocks = None, []

        def build():
            found = np.concatenate([x for _, low, _, more in blocks for x in (low, more, more)] or [np.zeros(0, np.uint32)])
            return np.unique(found, return_counts=True)

        for kind, batch, payload in rows:
            if kind == _BLOCKS:
                low, refs, more = split_bytes(payload, np.uint32, np.uint8, np.uint32)
                blocks.append((batch, low, refs, more))
                continue
            if index is None:
                index = build()
            low, refs = split_bytes(payload, np.uint32, np.uint8)
            hit = _holds(index[0], low)
            if hit.any():
                yield batch, pack_refs(unpack_refs(refs)[hit]).tobytes()
        if blocks:
            values, counts = index if index is not None else build()
            for batch, low, refs, _ in blocks:
                hit = counts[np.searchsorted(values, low)] > 1 if len(low) else np.zeros(0, bool)
                if hit.any():
                    yield batch, pack_refs(unpack_refs(refs)[hit]).tobytes()

    asked = rows.mapInArrow(ask, ROWS)
    return per_batch(answer(asked, buckets, reply), _positions, POSITIONS).dropDuplicates(["key", "copy"])


def _holds(index: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(index):
        return np.zeros(len(values), dtype=bool)
    return index[np.minimum(np.searchsorted(index, values), len(index) - 1)] == values


def _positions(own, replies: list[bytes]) -> Iterator[pa.RecordBatch]:
    """The hits of a batch by document, as places in the document."""
    keys, copies, first, extra = own
    parts = [np.frombuffer(extra, dtype=np.uint8), *(np.frombuffer(r, dtype=np.uint8) for r in replies)]
    refs = np.unique(np.concatenate([unpack_refs(p) for p in parts]))
    if not len(refs):
        return
    doc = np.searchsorted(first, refs, side="right") - 1
    cuts = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    ends = np.append(cuts[1:], len(doc))
    packed = [(refs[a:b] - first[doc[a]]).astype(np.uint32).tobytes() for a, b in zip(cuts, ends)]
    which = doc[cuts]
    yield pa.RecordBatch.from_arrays(
        [pa.array(keys[which]), pa.array(copies[which]), pa.array(packed, pa.binary())], names=["key", "copy", "positions"]
    )


def repeated_windows(hit: DataFrame, buckets: int) -> DataFrame:
    """Starts of windows that also start earlier: key, copy, positions; ``hit`` has texts and their hits.

    Hits are extended to the 20-word windows around them. Within a batch only
    the first start of a window can be the first of all, so each batch sends
    one entry for a window, with its id and place, and learns whether an
    earlier one exists.
    """

    def ask(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in enumerate(batches(stream, "text", BATCH_BYTES)):
            table = table.sort_by([("key", "ascending"), ("copy", "ascending")])
            keys, copies = _ids(table)
            batch = batch_id(keys, number)
            words = hash_words(table["text"])
            docs, n = words.docs, max(0, len(words.hashes) - WINDOW + 1)
            marks = np.zeros(len(words.hashes) + 1, dtype=np.int64)
            for first, places in zip(words.first, table["positions"].to_pylist()):
                marks[first + np.frombuffer(places, dtype=np.uint32).astype(np.int64) + 1] = 1
            marks = np.cumsum(marks)
            start = np.arange(n)
            near = marks[start + WINDOW - BLOCK + 1] > marks[start]
            at = np.flatnonzero(near & (docs[:n] == docs[WINDOW - 1 :][:n]))
            one = rolling(words.hashes, WINDOW)[at]
            two = rolling(words.hashes ^ np.uint64(0x5851F42D4C957F2D), WINDOW, 0xD1342543DE82EF95)[at]
            order = np.argsort(one, kind="stable")  # places of a window stay in the order of key, copy and place
            new = np.append(True, (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1]))[: len(order)]
            leader = at[order[np.flatnonzero(new)[np.cumsum(new) - 1]]] if len(order) else at
            place = lambda i: (keys[docs[i]], copies[docs[i]], i - words.first[docs[i]])
            own, led = place(at[order]), place(leader)
            later = ~new & ((own[0] != led[0]) | (own[1] != led[1]) | (own[2] != led[2]))
            out = [own_row(batch, buckets, keys, copies, words.first, pack_refs(np.sort(at[order][later])).tobytes())]
            sent = np.sort(order[new])
            for bucket, some in grouped(bucket_of(one[sent], buckets)):
                some = sent[some]
                key, copy, position = place(at[some])
                out.append(
                    (
                        bucket, _BLOCKS, batch,
                        join_bytes(one[some], (two[some] & _LOW).astype(np.uint32), key, copy, position.astype(np.uint32), pack_refs(at[some])),
                    )
                )
            yield rows_of(out)

    def reply(rows: Iterator[tuple[int, int, bytes]]) -> Iterator[tuple[int, bytes]]:
        parts, names = [], []
        for _, batch, payload in rows:
            parts.append(split_bytes(payload, np.uint64, np.uint32, np.int64, np.int64, np.uint32, np.uint8))
            names.append(batch)
        if len(parts) < 2:
            return
        one, two, key, copy, place = (np.concatenate([p[i] for p in parts]) for i in range(5))
        order = np.lexsort((place, copy, key, two, one))
        new = np.append(True, (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1]))
        leader = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
        later = np.zeros(len(order), dtype=bool)
        later[order] = (key[order] != key[leader]) | (copy[order] != copy[leader]) | (place[order] != place[leader])
        at = 0
        for batch, part in zip(names, parts):
            own = later[at : at + len(part[0])]
            at += len(part[0])
            if own.any():
                yield batch, pack_refs(unpack_refs(part[5])[own]).tobytes()

    asked = hit.mapInArrow(ask, ROWS)
    return per_batch(answer(asked, buckets, reply), _positions, POSITIONS).dropDuplicates(["key", "copy"])


def _find(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts that have hits, and the starts of their windows that also start earlier."""
    rows = _keyed(docs)
    buckets = bucket_count(rows)
    hits = spool(anchor_hits(rows, buckets), "hits")
    hit = spool(rows.join(hits, ["key", "copy"]), "hit-texts")
    return hit.drop("positions"), spool(repeated_windows(hit, buckets), "repeats")


def _cut(text: str, positions: bytes) -> tuple[bytes, int]:
    """The words that stay, joined by one space, and how many do not."""
    words = text.encode().split()
    change = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.frombuffer(positions, dtype=np.uint32).astype(np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + WINDOW, -1)
    gone = np.cumsum(change[:-1]) > 0
    return b" ".join([w for w, g in zip(words, gone) if not g]), int(gone.sum())


def kept_words(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document.

    A word is removed if a window of 20 consecutive words that covers it also
    starts earlier: in a smaller doc_id (null is the smallest; texts of one id
    are ordered by their hash) or earlier in the same text. Rows with equal id
    and text are one document and get the same result each. Null and empty
    texts have no words. Texts of any length are read whole.
    """
    hit, repeats = _find(docs)

    def measure(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(stream, "text", BATCH_BYTES):
            split = [t.encode().split() for t in table["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    table["key"].combine_chunks(),
                    table["copy"].combine_chunks(),
                    pa.array([len(w) for w in split], pa.int64()),
                    pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in split], pa.string()),
                ],
                names=["key", "copy", "n_words", "whole"],
            )

    def remove(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(stream, "text", BATCH_BYTES):
            done = [_cut(t, p) for t, p in zip(table["text"].to_pylist(), table["positions"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    table["key"].combine_chunks(),
                    table["copy"].combine_chunks(),
                    pa.array([n for _, n in done], pa.int64()),
                    pa.array([hashlib.sha256(w).hexdigest() for w, _ in done], pa.string()),
                ],
                names=["key", "copy", "n_removed", "left"],
            )

    rows = _keyed(docs).mapInArrow(measure, "key long, copy long, n_words long, whole string")
    changed = (
        hit.join(repeats, ["key", "copy"])
        .mapInArrow(remove, "key long, copy long, n_removed long, left string")
        .dropDuplicates(["key", "copy"])
    )
    return rows.join(changed, ["key", "copy"], "left").select(
        key_to_id().alias("doc_id"), "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("left", "whole").alias("kept_sha256"),
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The documents without the repeated words; all columns stay.

    A text that loses words becomes its kept words joined by one space (and
    n_chars, if there, their length); others stay as they are.
    """
    _, repeats = _find(docs)
    columns = docs.columns
    taken = {c.lower() for c in columns}
    key, copy, places, cut = (next(n for n in (f"{p}{i}" for i in range(len(taken) + 1)) if n not in taken) for p in ("k", "c", "p", "t"))

    @F.pandas_udf("string")
    def without(texts, positions):
        import pandas as pd

        return pd.Series([_cut(t, p)[0].decode() for t, p in zip(texts, positions)])

    joined = docs.withColumns({key: doc_key(), copy: F.xxhash64(whole_text())}).join(
        repeats.select(F.col("key").alias(key), F.col("copy").alias(copy), F.col("positions").alias(places)), [key, copy], "left"
    )
    changed = joined.where(F.col(places).isNotNull()).withColumn(cut, without("text", places))
    same = joined.where(F.col(places).isNull())
    new = {"text": F.col(cut), "n_chars": F.length(cut).cast(docs.schema["n_chars"].dataType) if "n_chars" in columns else None}
    return same.select(*columns).unionByName(changed.select(*(new[c].alias(c) if new.get(c) is not None else c for c in columns)))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without words that earlier windows hold."""
    return kept_words(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Prediction by partial matching: contexts of four bytes across words, escapes, symbol exclusion."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.common import LOWER, NO_ID, batches, doc_key, hash_words, is_space, mix, text_bytes, total_chars, whole_text, word_spans
from newsloom.llm.exchange import (
    ROWS, answer, batch_id, bucket_of, grouped, join_bytes, own_row, per_batch, rows_of, split_bytes,
)

FOLDS, HELD_OUT = 7, 2
#: Bytes of a context.
ORDER = 4
TEXT_END, SYMBOLS = 256, 257
PAD = 0x20
BUCKET_CHARS = 12_000_000
BATCH_BYTES = 6 << 20
#: Symbols whose contexts are worked out at once, and entries that are summed up at once.
CHUNK, MERGE = 3 << 21, 1 << 21
_TABLE_ROWS = 400_000
_LOWERED = bytes(LOWER)
COUNTED, ASKED = 0, 1


def is_held_out(column: str = "doc_id"):
    """crc32 of the id as text modulo 7 is 2."""
    return (F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % FOLDS) == HELD_OUT


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(doc_key().alias("key"), is_held_out().alias("held_out"), whole_text().alias("text"))


def vocabulary(rows: DataFrame) -> DataFrame:
    """word, c (tokens of documents to learn from) and seen (tokens of all documents)."""

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned, other = Counter(), Counter()

        def flush():
            words = [*learned, *(w for w in other if w not in learned)]
            c = np.asarray([learned[w] for w in words], dtype=np.int64)
            seen = c + np.asarray([other[w] for w in words], dtype=np.int64)
            learned.clear()
            other.clear()
            for low in range(0, len(words), 50_000):
                part = slice(low, low + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words[part], pa.binary()), pa.array(c[part]), pa.array(seen[part])], names=["word", "c", "seen"]
                )

        for table in batches(stream, "text", 1 << 20):
            for text, held in zip(table["text"].to_pylist(), table["held_out"].to_pylist()):
                (other if held else learned).update(text.encode().translate(_LOWERED).split())
            if len(learned) + len(other) > _TABLE_ROWS:
                yield from flush()
        yield from flush()

    counted = rows.mapInArrow(count, "word binary, c long, seen long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"), F.sum("seen").alias("seen"))


@dataclass
class Counts:
    """Counts of symbols after contexts: sorted entries (context * 257 + symbol), and sums by context."""

    entries: np.ndarray
    n: np.ndarray

    def __post_init__(self):
        owner = self.entries // SYMBOLS
        self.contexts, first = np.unique(owner, return_index=True)
        self.total = np.add.reduceat(self.n, first) if len(first) else np.zeros(0, dtype=np.int64)
        self.kinds = np.diff(np.append(first, len(owner)))

    def count(self, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        return _look_up(self.entries, self.n, context * SYMBOLS + symbol)

    def sums(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _look_up(self.contexts, self.total, context), _look_up(self.contexts, self.kinds, context)

    def mass(self, child: Counts, shorten) -> np.ndarray:
        """For each context of ``child``, how much of the shortened context's total its symbols take here."""
        owner = child.entries // SYMBOLS
        taken = self.count(shorten(owner), child.entries % SYMBOLS)
        return np.bincount(np.searchsorted(child.contexts, owner), taken, len(child.contexts)).astype(np.int64)


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


class Fallback:
    """Orders two, one and none: what is left when the word so far has not been seen to go on like this."""

    def __init__(self, entries: np.ndarray, n: np.ndarray):
        self.two = Counts(entries, n)
        self.one = _shorter(self.two, lambda c: c & 0xFF)
        self.none = _shorter(self.one, lambda c: c * 0)
        self.taken_one = self.one.mass(self.two, lambda c: c & 0xFF)
        self.taken_none = self.none.mass(self.one, lambda c: c * 0)

    def log10(self, context, symbol, taken=0, kinds=0) -> np.ndarray:
        """The log10 probability of symbols after two bytes, if symbols of a mass ``taken`` are excluded."""
        result = np.zeros(len(symbol))
        going = np.ones(len(symbol), dtype=bool)
        zero = np.zeros(len(symbol), dtype=np.int64)
        one = context & 0xFF
        levels = (
            (self.two, context, zero + taken, zero + kinds),
            (self.one, one, _look_up(self.two.contexts, self.taken_one, context), self.two.sums(context)[1]),
            (self.none, zero, _look_up(self.one.contexts, self.taken_none, one), self.one.sums(one)[1]),
        )
        for counts, where, out, gone in levels:
            total, types = counts.sums(where)
            total, types = total - out, types - gone
            found = counts.count(where, symbol)
            asked = going & (total > 0)
            below = np.log10(np.maximum(total + types, 1))
            hit = asked & (found > 0)
            result[hit] += np.log10(found[hit]) - below[hit]
            miss = asked & (found == 0)
            result[miss] += np.log10(types[miss]) - below[miss]
            going &= ~hit
        left = SYMBOLS - len(self.none.entries)
        result[going] -= np.log10(max(left, 1))
        return result


def _shorter(counts: Counts, shorten) -> Counts:
    key = shorten(counts.entries // SYMBOLS) * SYMBOLS + counts.entries % SYMBOLS
    entries, inverse = np.unique(key, return_inverse=True)
    return Counts(entries, np.bincount(inverse, counts.n, len(entries)).astype(np.int64))


def _sums(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    distinct, inverse = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(inverse, n, len(distinct)).astype(np.int64)


class Stream:
    """The symbols of a batch of texts: each word's bytes and a blank, then the text's end."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends = word_spans(data, offsets)
        blanks = np.cumsum(ends - starts + 1) - 1  # where each word's blank would be without what lies between texts
        self.texts = len(offsets) - 1
        first = np.searchsorted(starts, offsets)
        per_text = np.append(0, blanks + 1)[first]
        lead = np.arange(self.texts, dtype=np.int64) * (ORDER + 1) + ORDER  # blanks before each text, and the ends of those before
        self.first, self.end = per_text[:-1] + lead, per_text[1:] + lead  # each text's first symbol, and its end
        self.symbols = np.full(int(per_text[-1]) + self.texts * (ORDER + 1), PAD, dtype=np.uint8)
        of_word = np.ones(len(self.symbols), dtype=bool)
        of_word[blanks + np.repeat(lead, np.diff(first))] = False
        for before in range(ORDER + 1):
            of_word[self.first - before if before else self.end] = False
        self.symbols[of_word] = data[~is_space(data)]

    def chunks(self, order: int = ORDER) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Entries (context * 257 + symbol) of all places in order, and how many are of each text from the first on."""
        for low in range(0, len(self.symbols), CHUNK):
            high = min(low + CHUNK, len(self.symbols))
            before = max(low - order, 0)
            part = self.symbols[before:high]
            if low < order:
                part = np.append(np.full(order - low + before, PAD, dtype=np.uint8), part)
            entry = np.zeros(high - low, dtype=np.int64)
            for back in range(order):
                entry <<= 8
                entry |= part[back : back + high - low]
            entry *= SYMBOLS
            entry += part[order:]
            ends = self.end[(self.end >= low) & (self.end < high)] - low
            entry[ends] += TEXT_END - PAD
            real = np.ones(high - low, dtype=bool)
            for back in range(1, ORDER + 1):
                pads = self.first - back
                real[pads[(pads >= low) & (pads < high)] - low] = False
            per_text = np.minimum(self.end + 1, high) - np.maximum(self.first, low)
            yield entry[real], np.maximum(per_text, 0)

    def entries(self, learned: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
        """Distinct entries in order, and how often each occurs in the texts that are learned from."""
        keys, n = [], []
        for key, per_text in self.chunks(order):
            key *= 2
            key += np.repeat(learned, per_text)
            key.sort()
            new = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
            both, times = key[new], np.diff(np.append(new, len(key)))
            times *= both & 1
            both >>= 1
            # an entry that is met in texts of both kinds comes twice in a row
            new = np.flatnonzero(np.append(True, both[1:] != both[:-1])[: len(both)])
            keys.append(both[new])
            n.append(np.add.reduceat(times, new) if len(new) else times)
        if len(keys) == 1:
            return keys[0], n[0]
        return _sums(np.concatenate([np.zeros(0, dtype=np.int64), *keys]), np.concatenate([np.zeros(0, dtype=np.int64), *n]))


def _context_bucket(entries: np.ndarray, buckets: int) -> np.ndarray:
    return bucket_of(mix((entries // SYMBOLS).astype(np.uint64)), buckets)


def fallback_table(rows: DataFrame) -> Fallback:
    """The model of orders two to none, from the texts that are learned from.

    It has at most 256 * 256 contexts of 257 symbols each, however many texts
    there are; only these counts reach the driver.
    """

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for table in batches(stream, "text", BATCH_BYTES // 2):
            data, offsets = text_bytes(table["text"])
            own, times = Stream(LOWER[data], offsets).entries(np.ones(table.num_rows, dtype=bool), 2)
            keys, n = _sums(np.append(keys, own), np.append(n, times))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["entry", "n"])

    counted = rows.where("NOT held_out").select("text").mapInArrow(count, "entry long, n long")
    found = counted.groupBy("entry").agg(F.sum("n").alias("n")).toPandas().sort_values("entry")
    return Fallback(found["entry"].to_numpy(np.int64), found["n"].to_numpy(np.int64))


class Model:
    """All entries of some contexts of four bytes, and the shorter contexts below them."""

    def __init__(self, entries: np.ndarray, n: np.ndarray, fallback: Fallback):
        self.four, self.fallback = Counts(entries, n), fallback
        self.gone = fallback.two.mass(self.four, lambda c: c & 0xFFFF)

    def log10(self, entries: np.ndarray) -> np.ndarray:
        context, symbol = entries // SYMBOLS, entries % SYMBOLS
        total, kinds = self.four.sums(context)
        found = self.four.count(context, symbol)
        below = np.log10(np.maximum(total + kinds, 1))
        miss = found == 0
        result = np.log10(np.maximum(found, 1)) - below
        result[miss] = (np.log10(np.maximum(kinds, 1)) - below)[miss] + self.fallback.log10(
            context[miss] & 0xFFFF, symbol[miss], _look_up(self.four.contexts, self.gone, context)[miss], kinds[miss]
        )
        return result


class _Table:
    """Sums of counts by key, added up as they come."""

    def __init__(self):
        self.parts, self.size = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))], 0

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        learned = n > 0
        self.parts.append((keys[learned], n[learned].astype(np.int64)))
        self.size += len(keys)
        if self.size > max(MERGE, 2 * len(self.parts[0][0])):
            self.sums()

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        merged = _sums(*(np.concatenate([p[i] for p in self.parts]) for i in range(2)))
        self.parts, self.size = [merged], 0
        return merged


def score_texts(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    Learns from documents that are not held out. Tokens are words in lower
    case (A-Z only) and one end per text. ``score`` codes the words byte by
    byte, a blank after each, and the text's end: the context is the four bytes
    before, whatever words they are of (blanks before the text); where a byte
    has not followed it, an escape is paid and the contexts of the last two
    bytes, of one and of none are tried, without the symbols that the longer
    context has had; at last all symbols are equally likely. An escape has
    the share kinds / (n + kinds) in every context.

    Each batch of texts sums up its distinct contexts and symbols and sends
    them to buckets by the hash of the context, once with counts to learn from and
    once to be answered; it gets their log10 probabilities back.

    A null text is empty and has one token, the end. Very long texts are a
    batch of their own, worked through in pieces of bounded size that share
    the bytes at their borders. Other columns are left out, whatever their names.
    Null ids are kept and held out or not by the empty string. Repeated rows
    are documents of their own. With nothing to learn from, all symbols are
    equally likely.
    """
    rows = _rows(docs)
    buckets = max(1, -(-total_chars(rows) // BUCKET_CHARS))
    sums = vocabulary(rows).agg(F.sum("c").alias("c"), F.count_if(F.col("c") > 0).alias("v")).first()
    texts = rows.where(~F.col("held_out")).count()
    tokens, kinds = (sums["c"] or 0) + texts, (sums["v"] or 0) + (1 if texts else 0)
    below = np.log10(tokens + kinds + 1)

    def ask(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in enumerate(batches(stream, "text", BATCH_BYTES)):
            keys, held = table["key"].to_numpy(), table["held_out"].to_numpy()
            words = hash_words(table["text"], lower=True)
            batch = batch_id(keys, number)
            entries, n = Stream(words.data, words.offsets).entries(~held)
            hashes, word_n = _words_of(words, ~held)
            extra = join_bytes(held.astype(np.uint8), words.offsets, words.data)
            out = [own_row(batch, buckets, keys, np.diff(words.first) + 1, np.zeros(0), extra)]
            of_words = dict(grouped(bucket_of(hashes, buckets)))
            of_entries = dict(grouped(_context_bucket(entries, buckets)))
            none = np.zeros(0, dtype=np.int64)
            for bucket in sorted(of_words.keys() | of_entries.keys()):
                a, b = of_entries.get(bucket, none), of_words.get(bucket, none)
                counted = join_bytes(entries[a], n[a].astype(np.uint32), hashes[b], word_n[b].astype(np.uint32))
                out.append((bucket, COUNTED, batch, counted))
                out.append((bucket, ASKED, batch, join_bytes(entries[a], hashes[b])))
            yield rows_of(out)

    asked, fallback = rows.mapInArrow(ask, ROWS), fallback_table(rows)

    def reply(group: Iterator[tuple[int, int, bytes]]) -> Iterator[tuple[int, bytes]]:
        entries, words, model, known = _Table(), _Table(), None, None
        for kind, batch, payload in group:
            if kind == COUNTED:
                key, n, word, word_n = split_bytes(payload, np.int64, np.uint32, np.uint64, np.uint32)
                entries.add(key, n)
                words.add(word.view(np.int64), word_n)
                continue
            if model is None:
                model, known = Model(*entries.sums(), fallback), words.sums()
            key, word = split_bytes(payload, np.int64, np.int64)
            yield batch, join_bytes(np.asarray([_bucket(key, word, buckets)]), model.log10(key), _look_up(*known, word))

    def finish(own, replies: list[bytes]) -> Iterator[pa.RecordBatch]:
        keys, n_tokens, _, extra = own
        held, offsets, data = split_bytes(extra, np.uint8, np.int64, np.uint8)
        texts_again = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(keys), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]
        )
        words = hash_words(texts_again)
        answers = {}
        for payload in replies:
            bucket, logs, c = split_bytes(payload, np.int64, np.float64, np.int64)
            answers[int(bucket[0])] = (logs, c)
        stream, count = Stream(words.data, words.offsets), len(keys)
        entries, _ = stream.entries(held == 0)
        logs = np.zeros(len(entries))
        for bucket, at in grouped(_context_bucket(entries, buckets)):
            logs[at] = answers[bucket][0]
        score = np.zeros(count)
        for key, per_text in stream.chunks():
            score += np.bincount(np.repeat(np.arange(count), per_text), logs[np.searchsorted(entries, key)], count)
        hashes, _ = _words_of(words, held == 0)
        c = np.zeros(len(hashes), dtype=np.int64)
        for bucket, at in grouped(bucket_of(hashes, buckets)):
            c[at] = answers[bucket][1]
        own_c, docs_of = c[np.searchsorted(hashes, words.hashes)], words.docs
        base = np.bincount(docs_of, np.log10(own_c + 1) - below, count) + np.log10(texts + 1) - below
        known = np.bincount(docs_of, own_c > 0, count).astype(np.int64) + (1 if texts else 0)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys, mask=keys == NO_ID),
                pa.array(held.astype(bool)),
                pa.array(n_tokens),
                pa.array(known),
                pa.array(np.full(count, tokens, dtype=np.int64)),
                pa.array(base),
                pa.array(score),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return per_batch(answer(asked, buckets, reply), finish, schema)


def _words_of(words, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the words in order, and how often each occurs in the texts that are learned from."""
    return _sums(words.hashes, learned[words.docs])


def _bucket(entries: np.ndarray, hashes: np.ndarray, buckets: int) -> int:
    """The bucket that these are of."""
    if len(entries):
        return int(_context_bucket(entries[:1], buckets)[0])
    return int(bucket_of(hashes[:1].view(np.uint64), buckets)[0])


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from those that are not held out."""
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Quality rules: boosted trees over document statistics, on top of two fixed rules."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.boosting import Trees, fit
from newsloom.llm.common import batches, hash_words, mix, rolling, whole_text

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
#: Labelled rows that the trees are fitted on at most.
SAMPLE_ROWS = 20_000

_SYMBOLS = [ord(c) for c in "#*$%&|<>"]
_SPACES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
_BLANK = " \t\n\r\v\f"

#: Statistics that the trees see, and whether quality may only fall with them (-1).
FEATURES = {
    "log_words": 0,
    "mean_word": 0,
    "symbols_per_word": -1,
    "bars_per_word": -1,
    "exclamations_per_word": -1,
    "duplicate_lines": -1,
    "repeated_words": -1,
    "distinct_words": 0,
    "capitals": -1,
    "digits": 0,
    "letters": 0,
    "stops_per_word": 0,
    "lines_per_word": 0,
}
MONOTONE = np.asarray(list(FEATURES.values()))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The five counts of each text, and the trees' statistics."""
    words = hash_words(texts)
    n = len(texts)
    sizes = np.diff(words.first)
    histogram = np.zeros((n, 256), dtype=np.int64)
    for i, (a, b) in enumerate(zip(words.offsets[:-1], words.offsets[1:])):
        if b > a:
            histogram[i] = np.bincount(words.data[a:b], minlength=256)
    points = histogram.sum(1) - histogram[:, 0x80:0xC0].sum(1)
    word_chars = points - histogram[:, _SPACES].sum(1)
    symbols = histogram[:, _SYMBOLS].sum(1)

    duplicates = np.zeros(n, dtype=np.int64)
    for i, text in enumerate(texts.to_pylist()):
        lines = [line for line in text.split("\n") if line.strip(_BLANK)]
        duplicates[i] = len(lines) - len(set(lines))

    docs = words.docs
    repeated = _repeated(words.hashes, docs, n)
    share = _distinct(words.hashes, docs, n) / np.maximum(sizes, 1)
    counts = np.stack([sizes, word_chars, symbols, duplicates, repeated], axis=1)

    per_word = 1 / np.maximum(sizes, 1)
    upper = histogram[:, 65:91].sum(1)
    letters = upper + histogram[:, 97:123].sum(1) + histogram[:, 0xC2:0xF5].sum(1)
    lines = histogram[:, 10] + 1
    stats = np.stack(
        [
            np.log1p(sizes),
            word_chars * per_word,
            symbols * per_word,
            histogram[:, ord("|")] * per_word,
            histogram[:, ord("!")] * per_word,
            duplicates / lines,
            repeated * per_word,
            share,
            upper / np.maximum(letters, 1),
            histogram[:, 48:58].sum(1) / np.maximum(word_chars, 1),
            letters / np.maximum(word_chars, 1),
            histogram[:, [ord("."), ord(",")]].sum(1) * per_word,
            lines * per_word,
        ],
        axis=1,
    )
    return counts, stats


def _repeated(hashes: np.ndarray, docs: np.ndarray, n: int) -> np.ndarray:
    """Words of each document that lie in a window found twice or more in it."""
    windows = rolling(hashes, WINDOW)
    inside = np.flatnonzero(docs[: len(windows)] == docs[WINDOW - 1 :][: len(windows)]) if len(windows) else np.zeros(0, int)
    keys = mix(windows[inside] + docs[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(change, inside[twice], 1)
    np.add.at(change, inside[twice] + WINDOW, -1)
    covered = np.cumsum(change[:-1]) > 0
    return np.bincount(docs[covered], minlength=n)


def _distinct(hashes: np.ndarray, docs: np.ndarray, n: int) -> np.ndarray:
    keys = mix(hashes + docs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    fresh = np.append(True, keys[order][1:] != keys[order][:-1])[: len(keys)]
    return np.bincount(docs[order[fresh]], minlength=n)


def base_failed(counts: np.ndarray) -> np.ndarray:
    """The two fixed rules: too few words, or too many of them repeated."""
    return (counts[:, 0] < LEAST_WORDS) | (100 * counts[:, 4] > MOST_REPEATED_PERCENT * counts[:, 0])


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Trees for labels.quality, from at most ``sample_rows`` labelled documents.

    The labels are those with the least hash of their id, and of their documents
    those with the least hash of the row, as an id may be repeated. Labels that are null
    are left out; with no labels, or one class, the trees accept everything
    of that class (without any label: accept).
    """
    chosen = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(sample_rows)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    names = list(FEATURES)

    def statistics(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(stream, "text", 4 << 20):
            _, stats = measure(table["text"])
            yield pa.RecordBatch.from_arrays(
                [table["row"].combine_chunks(), table["quality"].combine_chunks(), *(pa.array(stats[:, j]) for j in range(len(names)))],
                names=["row", "quality", *names],
            )

    schema = "row long, quality int, " + ", ".join(f"{x} double" for x in names)
    # the sample is bounded by its parameter, so it may be sent to all tasks; ids may be repeated, so what it finds is bounded again
    found = rows.join(F.broadcast(chosen), "doc_id").select("text", "quality", F.xxhash64("doc_id", "text", "quality").alias("row"))
    sample = found.mapInArrow(statistics, schema).orderBy("row", "quality", *names).limit(sample_rows).drop("row").toPandas()
    if sample.empty:
        trees = fit(np.zeros((0, len(names))), np.zeros(0))
        trees.bias = 1.0
        return trees
    sample = sample.sort_values(list(sample.columns))
    return fit(sample[names].to_numpy(), (sample["quality"] > 0).to_numpy().astype(float), MONOTONE)


def verdicts(docs: DataFrame, trees: Trees) -> DataFrame:
    """Per document the counts, base_failed, the trees' score and whether it is kept.

    A null or empty text has no words and fails. Texts are read whole;
    repeated rows get the same verdict each.
    """

    def judge(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(stream, "text", 4 << 20):
            counts, stats = measure(table["text"])
            failed, score = base_failed(counts), trees.probability(stats)
            yield pa.RecordBatch.from_arrays(
                [
                    table["doc_id"].combine_chunks(),
                    *(pa.array(counts[:, j]) for j in range(len(COUNTS))),
                    pa.array(failed),
                    pa.array(~failed & (score >= 0.5)),
                    pa.array(score),
                ],
                names=["doc_id", *COUNTS, "base_failed", "kept", "score"],
            )

    schema = "doc_id long, " + ", ".join(f"{x} long" for x in COUNTS) + ", base_failed boolean, kept boolean, score double"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(judge, schema)


def keep_good(docs: DataFrame, trees: Trees, text_column: str = "text") -> DataFrame:
    """The documents that are kept, all their columns unchanged."""
    at = docs.columns.index(text_column)

    def keep(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(stream, text_column, 4 << 20):
            counts, stats = measure(pc.fill_null(table.column(at), ""))
            good = ~base_failed(counts) & (trees.probability(stats) >= 0.5)
            yield from table.filter(pa.array(good)).combine_chunks().to_batches()

    return docs.mapInArrow(keep, docs.schema)


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all documents; the trees learn from labels.quality."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return verdicts(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))

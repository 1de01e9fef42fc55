"""Toxicity: boosted trees over lexicon densities and writing habits, with isotonic calibration."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.boosting import Isotonic, Trees, fit, isotonic
from newsloom.llm.common import batches, spool, text_bytes, whole_text

#: Labelled rows that the lexicon, the trees and the calibration are fitted on at most.
SAMPLE_ROWS = 20_000
#: Learned entries of the lexicon at most; the strongest are taken.
LEXICON_SIZE = 2_000
#: Toxic documents that a learned entry occurs in at least.
LEAST_DOCUMENTS = 3
HELD_OUT = 5
FOLDS = 2

#: Common insults of English, lower case, a list of our own.
INSULTS = (
    "clown coward creep disgusting dumb fool freak garbage hate idiot idiotic idiots imbecile jerk kill liar "
    "loser losers moron morons pathetic pig rat scum shame shut stupid trash ugly vermin worthless"
).split()
#: Second person in English, German, French and Spanish.
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros"
).split()

_NEAR = 40
_YOU = re.compile(r"(?<!\w)(?:" + "|".join(SECOND_PERSON) + r")(?!\w)")
_LOOKALIKES = str.maketrans("013457@$!", "oieastasi", "*_-.")
_DISGUISE = np.zeros(256, dtype=bool)
_DISGUISE[[ord(c) for c in "013457@$!*_"]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True

FEATURES = (
    "log_letters",
    "insults",
    "insult_density",
    "learned",
    "learned_density",
    "learned_distinct",
    "learned_strongest",
    "learned_sum",
    "near_second_person",
    "second_person",
    "capitals",
    "exclamations",
    "question_marks",
    "punctuation",
    "obfuscation",
    "obfuscated_insults",
)
#: Toxicity may only rise with these.
_RISING = {"insults", "learned", "learned_distinct", "learned_strongest", "learned_sum", "obfuscated_insults"}
MONOTONE = np.asarray([1 if f in _RISING else 0 for f in FEATURES])


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: Trees
    calibration: Isotonic

    def score(self, stats: np.ndarray) -> np.ndarray:
        return self.calibration(self.trees.margin(stats))


def automaton(entries: dict[str, float]):
    """Finds all entries in one reading of a text; an entry that ends in ``*`` is the start of a word."""
    import ahocorasick

    found = ahocorasick.Automaton()
    joined: dict[str, list] = {}
    for entry, weight in entries.items():
        start = entry.endswith("*")
        joined.setdefault(entry.rstrip("*"), []).append((entry, start, weight))
    for entry, values in joined.items():
        found.add_word(entry, (len(entry), values))
    if joined:
        found.make_automaton()
    return found if joined else None


def _hits(finder, text: str) -> list[tuple[int, int, str, float]]:
    out = []
    if finder is None:
        return out
    n = len(text)
    for last, (size, values) in finder.iter(text):
        low, high = last - size + 1, last + 1
        if low and text[low - 1].isalnum():
            continue
        whole = high == n or not text[high].isalnum()
        out += [(low, high, entry, weight) for entry, start, weight in values if whole or start]
    return out


def measure(texts: pa.ChunkedArray, insults, learned) -> np.ndarray:
    """The trees' features of each text."""
    data, offsets = text_bytes(texts)
    rows = np.zeros((len(texts), len(FEATURES)))
    disguised = np.zeros(len(data), dtype=bool)
    if len(data) > 2:
        disguised[1:-1] = _DISGUISE[data[1:-1]] & _LETTER[data[:-2]] & _LETTER[data[2:]]
    for i, text in enumerate(texts.to_pylist()):
        low, high = int(offsets[i]), int(offsets[i + 1])
        histogram = np.bincount(data[low:high], minlength=256)
        upper = int(histogram[65:91].sum())
        letters = upper + int(histogram[97:123].sum()) + int(histogram[0xC2:0xF5].sum())
        per_hundred = 100 / max(letters, 20)
        lowered = text.lower()
        own, taught = _hits(insults, lowered), _hits(learned, lowered)
        near = sum(
            1 for a, b, _, _ in {x[:2]: x for x in own + taught}.values() if _YOU.search(lowered[max(0, a - _NEAR) : b + _NEAR])
        )
        hidden = int(np.count_nonzero(disguised[low:high]))
        revealed = len(_hits(insults, lowered.translate(_LOOKALIKES))) - len(own) if hidden else 0
        weights = [x[3] for x in taught]
        marks = int(histogram[[ord(c) for c in ".,;:'\"()-"]].sum())
        rows[i] = (
            np.log1p(letters),
            len(own),
            len(own) * per_hundred,
            len(taught),
            len(taught) * per_hundred,
            len({x[2] for x in taught}),
            max(weights, default=0.0),
            sum(weights),
            near,
            len(_YOU.findall(lowered)) * per_hundred if near else 0.0,
            upper / max(letters, 1),
            histogram[ord("!")] * per_hundred,
            histogram[ord("?")] * per_hundred,
            marks * per_hundred,
            hidden * per_hundred,
            max(0, revealed),
        )
    return rows


def remainder(column: str = "doc_id"):
    """crc32 of the id as text modulo 5; 0 is held out."""
    return (F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % HELD_OUT).cast("int")


def learn_lexicon(sample: DataFrame, size: int = LEXICON_SIZE) -> list[dict[str, float]]:
    """Words and starts of words that toxic documents have far more often than others.

    ``sample`` has text, toxic and fold. Returns one lexicon for each fold,
    learned from the rows of the other folds, then one from all rows. A weight
    is the log of the ratio of smoothed document frequencies.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1)))

    def starts(word):
        return F.array(word, *(F.when(F.length(word) > n, F.concat(F.substring(word, 1, n), F.lit("*"))) for n in (4, 5, 6)))

    own = F.array_distinct(F.array_compact(F.flatten(F.transform(words, starts))))  # a document counts once
    entries = sample.select("toxic", "fold", F.explode(own).alias("entry"))
    totals = {(r["fold"], r["toxic"]): r["count"] for r in sample.groupBy("fold", "toxic").count().collect()}
    counted = spool(
        entries.groupBy("entry")
        .agg(*(F.count_if((F.col("fold") == f) & (F.col("toxic") == t)).alias(f"n{f}{t}") for f in range(FOLDS) for t in (0, 1)))
        .where(sum(F.col(f"n{f}1") for f in range(FOLDS)) >= LEAST_DOCUMENTS),
        "lexicon",
    )
    out = []
    for left_out in (*range(FOLDS), None):
        folds = [f for f in range(FOLDS) if f != left_out]
        n = {t: sum(totals.get((f, t), 0) for f in folds) for t in (0, 1)}
        bad, fine = (sum(F.col(f"n{f}{t}") for f in folds) for t in (1, 0))
        weight = F.log((bad + 0.5) / (n[1] + 1)) - F.log((fine + 0.5) / (n[0] + 1))
        rows = (
            counted.withColumn("bad", bad).withColumn("weight", weight)
            .where((F.col("bad") >= max(LEAST_DOCUMENTS, n[1] // 200)) & (F.col("weight") > 2.5))
            .orderBy(F.desc(F.col("weight") * F.log1p("bad")), "entry").limit(size).select("entry", "weight")
        )
        out.append({r["entry"]: r["weight"] for r in rows.collect()})
    return out


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on labelled documents that are not held out, ``sample_rows`` of them at most.

    The lexicon that a row is measured with comes from the other fold, and so
    do the margins that the calibration is fitted on. Null labels are left
    out. Without any label nothing is predicted toxic.
    """
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (remainder() != 0))
        .select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic")
        .limit(sample_rows)
    )
    # the sample is bounded by its parameter, so it may be sent to all tasks
    sample = spool(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .select("text", "toxic", F.xxhash64("doc_id", "text", "toxic").alias("row"))
        .withColumn("fold", F.pmod("row", F.lit(FOLDS)).cast("int")),
        "toxic-sample",
    )
    lexicons = learn_lexicon(sample)

    def features(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        insults = automaton(dict.fromkeys(INSULTS, 1.0))
        finders = [automaton(x) for x in lexicons]
        for table in batches(stream, "text", 4 << 20):
            fold = table["fold"].to_numpy()
            for f in range(FOLDS):
                own = table.filter(pa.array(fold == f))
                if own.num_rows:
                    stats = measure(own["text"], insults, finders[f])
                    yield pa.RecordBatch.from_arrays(
                        [*(own[c].combine_chunks() for c in ("row", "toxic", "fold")), *(pa.array(stats[:, j]) for j in range(len(FEATURES)))],
                        names=["row", "toxic", "fold", *FEATURES],
                    )

    schema = "row long, toxic int, fold int, " + ", ".join(f"{x} double" for x in FEATURES)
    measured = sample.select("row", "text", "toxic", "fold").mapInArrow(features, schema)
    # ids may be repeated, so the rows that the labels find are bounded again
    rows = measured.orderBy("row", "toxic", *FEATURES).limit(sample_rows).drop("row").toPandas()
    rows = rows.sort_values(list(rows.columns))
    stats, toxic, fold = rows[list(FEATURES)].to_numpy(), rows["toxic"].to_numpy().astype(float), rows["fold"].to_numpy()
    margin = np.zeros(len(rows))
    for f in range(FOLDS):
        margin[fold == f] = fit(stats[fold != f], toxic[fold != f], MONOTONE).margin(stats[fold == f])
    trees = fit(stats, toxic, MONOTONE)
    if not len(rows):
        trees.bias = -1.0
    return Model(lexicons[-1], trees, isotonic(margin, toxic))


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for every document, each text read whole.

    Only the text enters a score. A null text is empty and is scored too;
    repeated rows get the same score each.
    """

    def judge(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        insults, learned = automaton(dict.fromkeys(INSULTS, 1.0)), automaton(model.lexicon)
        for table in batches(stream, "text", 4 << 20):
            score = np.clip(model.score(measure(table["text"], insults, learned)), 0, 1)
            yield pa.RecordBatch.from_arrays(
                [
                    table["doc_id"].combine_chunks(),
                    table["held_out"].combine_chunks(),
                    pa.array(score),
                    pa.array((score >= 0.5).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder() == 0).alias("held_out"), whole_text().alias("text"))
    return rows.mapInArrow(judge, "doc_id long, held_out boolean, score double, predicted int")


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; learned from labels.toxic of rows that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scores(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))

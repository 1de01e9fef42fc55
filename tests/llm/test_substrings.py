from __future__ import annotations

import hashlib
import random

import pytest
from .conftest import words

from newsloom.llm import exchange, substrings


def brute(rows, size=20):
    """Rows in the order of id and text's hash do not matter here but for equal ids, which share no window."""
    seen, out = set(), {}
    for doc, text in sorted({(r[0], r[1]) for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        own = words(text)
        gone = [False] * len(own)
        for i in range(len(own) - size + 1):
            window = tuple(own[i : i + size])
            if window in seen:
                gone[i : i + size] = [True] * size
            seen.add(window)
        kept = [w for w, g in zip(own, gone) if not g]
        out[doc, text] = (doc, len(own), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return sorted(map(repr, (out[r[0], r[1]] for r in rows)))


@pytest.mark.parametrize(("bucket", "batch"), [(exchange.BUCKET_CHARS, exchange.BATCH_BYTES), (4000, 3000)])
def test_equals_brute_force(docs, rows, monkeypatch, bucket, batch):
    monkeypatch.setattr(exchange, "BUCKET_CHARS", bucket)
    monkeypatch.setattr(substrings, "BATCH_BYTES", batch)
    assert sorted(repr(tuple(r)) for r in substrings.kept_words(docs).collect()) == brute(rows)


@pytest.mark.parametrize("seed", range(3))
def test_texts_of_few_words(spark, monkeypatch, seed):
    """Windows repeat everywhere, also overlapping in one text."""
    monkeypatch.setattr(exchange, "BUCKET_CHARS", 3000)
    monkeypatch.setattr(substrings, "BATCH_BYTES", 2500)
    rng = random.Random(seed)
    parts = ["".join(rng.choice("ab ") for _ in range(90)) for _ in range(4)]
    rows = [(i, rng.choice(["", "x "]) + " ".join(rng.choice(parts) for _ in range(rng.randint(0, 5)))) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(repr(tuple(r)) for r in substrings.kept_words(frame).collect()) == brute(rows)


def test_documents_keep_their_columns(docs, rows):
    got = substrings.remove_repeats(docs)
    assert got.columns == docs.columns and got.count() == len(rows)
    digests = {r["doc_id"]: r for r in substrings.kept_words(docs).collect()}
    for r in got.collect():
        if r["doc_id"] not in (6, 7):
            assert hashlib.sha256(" ".join(words(r["text"])).encode()).hexdigest() == digests[r["doc_id"]]["kept_sha256"]


def test_empty_table(no_docs):
    assert substrings.kept_words(no_docs).count() == 0
    assert substrings.remove_repeats(no_docs).count() == 0

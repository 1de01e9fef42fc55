from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from .conftest import words

from newsloom.llm import mixing


def share(budget, children):
    """children: name to (weight, capacity). What each gets; a full one's rest goes to the others by weight."""
    got, left = {}, dict(children)
    while left:
        weights = sum(w for w, _ in left.values())
        full = [n for n, (w, c) in left.items() if c * weights <= budget * w]
        if not full:
            return got | {n: budget * w // weights for n, (w, _) in left.items()}
        name = min(full, key=lambda n: (left[n][1] / left[n][0], n))
        got[name] = left.pop(name)[1]
        budget -= got[name]
    return got


def brute(rows, weights, percent, epochs, seed):
    """rows: (doc_id, a, b, tokens)."""
    rows = [r for r in rows if r[3] > 0]
    sizes = defaultdict(lambda: defaultdict(int))
    for _, a, b, tokens in rows:
        sizes[a][b] += tokens
    total = sum(r[3] for r in rows) * percent // 100
    top = share(total, {a: (weights[0].get(a, 1), sum(own.values()) * epochs) for a, own in sizes.items()})
    out = []
    for a, own in sizes.items():
        for b, budget in share(top[a], {b: (weights[1].get(b, 1), n * epochs) for b, n in own.items()}).items():
            for epoch in range(epochs):
                goal, start = min(own[b], budget - epoch * own[b]), 0
                leaf = [r for r in rows if r[1] == a and r[2] == b]
                for doc, _, _, tokens in sorted(leaf, key=lambda r: (hashlib.md5(f"{seed}:{epoch}:{r[0]}".encode()).hexdigest(), r[0])):
                    if start < goal:
                        out.append((doc, a, b, epoch, tokens, start, min(tokens, goal - start)))
                    start += tokens
    return Counter(out)


@pytest.mark.parametrize("slice_rows", [mixing.SLICE_ROWS, 5])
@pytest.mark.parametrize(("percent", "epochs"), [(60, 2), (10, 1), (250, 3), (400, 2)])
def test_equals_brute_force(spark, monkeypatch, percent, epochs, slice_rows):
    monkeypatch.setattr(mixing, "SLICE_ROWS", slice_rows)
    rng = random.Random(percent)
    percent = min(percent, 100 * epochs)
    rows = [(i, rng.choice(["x", "x", "x", "y", "z"]), rng.choice(["p", "q", "r"]), rng.choice([0, 1, 5, 40])) for i in range(150)]
    weights = ({"x": 1, "y": 5}, {"p": 3})
    frame = spark.createDataFrame(rows, "doc_id long, a string, b string, tokens long")
    got = mixing.choose(frame, ("a", "b"), weights, percent, epochs, 3).collect()
    assert Counter(tuple(r) for r in got) == brute(rows, weights, percent, epochs, 3)


def test_nulls_and_empty(spark, docs, rows, no_docs):
    from pyspark.sql import functions as F

    own = docs.select("doc_id", F.lit("d").alias("domain"), "lang", "source", mixing.n_tokens().alias("tokens"))
    got = mixing.choose(own, percent=100, epochs=1).collect()
    full = Counter(r[0] for r in rows if words(r[1]))
    assert Counter(r["doc_id"] for r in got) == full
    assert sum(r["taken"] for r in got) == sum(len(words(r[1])) for r in rows)
    assert any(r["lang"] is None for r in got) and any(r["source"] is None for r in got)
    assert mixing.mix_documents(no_docs).count() == 0


def test_documents_keep_their_columns(docs):
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and 0 < mixed.count() <= 2 * docs.count()


def test_no_python_in_the_plan(spark):
    plan = mixing.source_mix(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_equals_sql(spark):
    from checks.compare import _plain, connect

    folder = "/root/testdata/sf0.001"
    assert _plain(mixing.source_mix(spark, folder).toPandas()) == _plain(connect(folder).execute(mixing.oracle_sql()).df())

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from .conftest import words

from newsloom.llm import boosting, quality, toxicity


def counts(text):
    own, text = words(text), text or ""
    lines = [x for x in text.split("\n") if words(x)]
    windows = Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))
    covered = {j for i in range(len(own) - 4) if windows[tuple(own[i : i + 5])] > 1 for j in range(i, i + 5)}
    n = len(own)
    return n, sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts_and_base_rule(spark, docs, rows):
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 40)], "doc_id long, quality int")
    got = quality.verdicts(docs, quality.train(docs, labels)).collect()
    wanted = Counter((r[0], *counts(r[1])) for r in rows)
    assert Counter(tuple(r)[:6] for r in got) == wanted
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_quality_without_labels_keeps_what_passes(spark, docs, no_docs):
    none = spark.createDataFrame([(1, None)], "doc_id long, quality int")
    trees = quality.train(docs, none)
    assert all(r["kept"] != r["base_failed"] for r in quality.verdicts(docs, trees).collect())
    assert quality.verdicts(no_docs, trees).count() == 0
    kept = quality.keep_good(docs, trees)
    assert kept.schema == docs.schema
    assert kept.count() == quality.verdicts(docs, trees).where("kept").count()
    assert quality.keep_good(no_docs, trees).count() == 0


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    trees = quality.train(docs, labels.where("doc_id % 2 = 0"))
    rows = quality.verdicts(docs, trees).join(labels.where("doc_id % 2 = 1"), "doc_id").where("NOT base_failed").collect()
    right = sum(r["kept"] == (r["quality"] == 1) for r in rows)
    assert right >= 0.97 * len(rows)
    good = [r for r in rows if r["quality"] == 1]
    assert sum(r["kept"] for r in good) >= 0.99 * len(good)


def test_trees_are_monotone_and_fit():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(3000, 3))
    target = ((rows[:, 0] + np.sin(3 * rows[:, 1]) + 0.3 * rng.normal(size=3000)) > 0).astype(float)
    trees = boosting.fit(rows[:2000], target[:2000], np.asarray([1, 0, -1]))
    assert ((trees.probability(rows[2000:]) > 0.5) == (target[2000:] > 0.5)).mean() > 0.85
    for feature, sign in ((0, 1), (2, -1)):
        grid = np.repeat(rows[:50], 40, axis=0)
        grid[:, feature] = np.tile(np.linspace(-3, 3, 40), 50)
        steps = np.diff(trees.margin(grid).reshape(50, 40), axis=1)
        assert (steps * sign >= -1e-9).all()


def test_isotonic_rises_and_pools():
    margin = np.asarray([0.0, 1, 2, 3, 4, 5, 5])
    step = boosting.isotonic(margin, np.asarray([0.0, 1, 0, 0, 1, 1, 0]))
    levels = step(np.linspace(-1, 6, 50))
    assert (np.diff(levels) >= 0).all() and 0 < levels.min() < levels.max() < 1
    assert len(boosting.isotonic(margin, np.zeros(7)).edges) == 0


def held_out(doc):
    return zlib.crc32(str("" if doc is None else doc).encode()) % 5 == 0


def test_toxicity_of_every_row(spark, docs, rows, no_docs):
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(40)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.scores(docs, model).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) and r["held_out"] == held_out(r["doc_id"])
    assert toxicity.scores(no_docs, model).count() == 0
    nothing = toxicity.train(docs, labels.where("false"))
    assert {r["predicted"] for r in toxicity.scores(docs, nothing).collect()} == {0}


def test_held_out_toxicity(spark):
    """Insults, learned words, and no use of labels that are held out."""
    rng = random.Random(2)
    vocabulary = ["".join(rng.choice("lmnorst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(600)]
    rows, labels = [], []
    for i in range(900):
        own = [rng.choice(vocabulary) for _ in range(rng.randint(20, 200))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randint(2, 6)):
                own[rng.randrange(len(own))] = rng.choice(["idiot", "zzka" + rng.choice(vocabulary), "zzka" + rng.choice(vocabulary)])
        rows.append((i, " ".join(own)))
        labels.append((i, int(toxic) if not held_out(i) else int(not toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = toxicity.scores(docs, model).where("held_out").collect()
    assert sum(r["predicted"] == int(r["doc_id"] % 6 == 0) for r in got) >= 0.97 * len(got)


def test_features_see_disguise_and_second_person():
    import pyarrow as pa

    insults = toxicity.automaton(dict.fromkeys(toxicity.INSULTS, 1.0))
    learned = toxicity.automaton({"vex*": 2.0, "grot": 3.0})
    texts = ["you are an idiot", "an id1ot and m*ron", "vexing grotto GROT!", "idiotically", ""]
    stats = {f: toxicity.measure(pa.chunked_array([texts]), insults, learned)[:, j] for j, f in enumerate(toxicity.FEATURES)}
    assert stats["insults"].tolist() == [1, 0, 0, 0, 0]
    assert stats["near_second_person"].tolist() == [1, 0, 0, 0, 0]
    assert stats["obfuscated_insults"].tolist() == [0, 1, 0, 0, 0]
    assert stats["learned"].tolist() == [0, 0, 2, 0, 0] and stats["learned_strongest"][2] == 3


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_rows_of_repeated_ids_are_bounded(spark, monkeypatch, module, label):
    """However many rows a labelled id has, the driver gets as many as the sample may have."""
    sizes, fit = [], module.fit

    def counted(stats, *more):
        sizes.append(len(stats))
        return fit(stats, *more)

    monkeypatch.setattr(module, "fit", counted)
    docs = spark.createDataFrame([(i % 8, f"text {i} of many words") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], f"doc_id long, {label} int")
    module.train(docs, labels, 10)
    assert max(sizes) == 10

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from .conftest import words

from newsloom.llm import near_dedup


def grams(text):
    own = words(text)
    return Counter(tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))) if own else Counter()


def probability_jaccard(a, b):
    keys = sorted(a.keys() | b.keys())
    x, y = np.asarray([a[k] for k in keys], float), np.asarray([b[k] for k in keys], float)
    return sum(1 / np.maximum(x / u, y / v).sum() for u, v in zip(x, y) if u and v)


def test_similarity_equals_its_definition():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (Counter(rng.integers(0, 30, rng.integers(1, 60)).tolist()) for _ in range(2))
        pack = lambda c: (np.asarray(sorted(c), np.uint64), np.asarray([c[k] for k in sorted(c)], np.uint32))
        assert near_dedup.similarity(*pack(a), *pack(b)) == pytest.approx(probability_jaccard(a, b))


def test_registers_agree_with_the_similarity():
    rng = np.random.default_rng(2)
    texts = []
    for _ in range(150):
        own = [str(x) for x in rng.integers(0, 10**6, 120)]
        for share in (0, rng.integers(1, 60)):
            changed = own[: 120 - share] + [str(x) for x in rng.integers(0, 10**6, share)]
            texts.append(" ".join(changed + changed[:20]))
    owner, value, count, _ = near_dedup.shingles(pa.chunked_array([texts]))
    taken = near_dedup.probminhash(owner, value, count.astype(float), len(texts))
    agree = (taken[0::2] == taken[1::2]).mean(1)
    wanted = np.asarray([probability_jaccard(grams(a), grams(b)) for a, b in zip(texts[0::2], texts[1::2])])
    assert abs((agree - wanted).mean()) < 0.01 and np.abs(agree - wanted).max() < 0.2
    assert (taken != 0).all()


def brute(rows):
    """Groups and classes by all pairs of different texts."""
    texts = sorted({(r[0], r[1]) for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    shingled = [grams(t) for _, t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if words(texts[i][1]) == words(texts[j][1]) or (
                shingled[i].keys() & shingled[j].keys() and probability_jaccard(shingled[i], shingled[j]) >= 0.8
            ):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {t: texts[find(i)] for i, t in enumerate(texts)}, texts


@pytest.mark.parametrize("small", [near_dedup.SMALL_BUCKET, 1])
def test_groups_equal_brute_force(docs, rows, monkeypatch, small):
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", small)
    monkeypatch.setattr(near_dedup, "CHUNK", 3)
    monkeypatch.setattr(near_dedup, "BATCH_BYTES", 3000)
    roots, texts = brute(rows)
    got = near_dedup.near_duplicates(docs)
    assert got.count() == len(rows)
    by = {}
    for r in got.collect():
        by.setdefault(r["key"], set()).add(r["group"])
    for doc in {r[0] for r in rows}:
        key = -(2**63) if doc is None else doc
        wanted = {-(2**63) if roots[t][0] is None else roots[t][0] for t in texts if t[0] == doc}
        assert by[key] == wanted, doc


def test_one_of_each_group_stays(docs, rows, no_docs):
    roots, texts = brute(rows)
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    wordless = {t for t in texts if not words(t[1])}
    wanted = len({roots[t] for t in texts if t not in wordless}) + len(wordless)
    assert kept.count() == wanted
    assert near_dedup.keep_one(no_docs).count() == 0 and near_dedup.near_duplicates(no_docs).count() == 0


def test_chains_and_large_groups(spark):
    """Each text is near the next only; and many copies with one change each are near their origin."""
    base = [f"w{i}" for i in range(100)]
    rows, own = [], list(base)
    for i in range(12):
        rows.append((i, " ".join(own)))
        own = list(own)
        own[8 * i + 2] = f"c{i}"
    origin = [f"o{i}" for i in range(150)]
    for i in range(80):
        changed = list(origin)
        changed[i + 5] = f"x{i}"
        rows.append((100 + i, " ".join(changed)))
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["key"] >= 100, r["group"]) for r in got} == {(False, 0), (True, 100)}


def around_one_template(n=90):
    """Texts that keep most of a template, each with changes of its own (similarities lie on both sides of 0.8)."""
    rng = np.random.default_rng(11)
    template = [f"t{i}" for i in range(200)]
    rows = []
    for i in range(n):
        own = list(template)
        for k, at in enumerate(rng.choice(195, rng.integers(1, 7), replace=False)):
            own[at] = f"x{i}y{k}"
        own[0] = own[1] = own[2] = f"z{i % 30}"
        rows.append((i, " ".join(own + own[100 : 100 + 10 * (i % 2)])))
    return rows


@pytest.mark.parametrize("block", [near_dedup.BLOCK_TEXTS, 7])
def test_large_buckets_are_compared_whole(spark, monkeypatch, block):
    """No group is lost in a large bucket, whichever texts its hubs are."""
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", 1)
    monkeypatch.setattr(near_dedup, "BLOCK_TEXTS", block)
    rows = around_one_template()
    roots, texts = brute(rows)
    got = {r["key"]: r["group"] for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {t[0]: roots[t][0] for t in texts}


@pytest.mark.parametrize("small", [near_dedup.SMALL_BUCKET, 100, 1])
def test_links_are_counted_by_all_pairs(spark, monkeypatch, small):
    """In small and large buckets, and in both, each pair counts once for both of its texts."""
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", small)
    monkeypatch.setattr(near_dedup, "BLOCK_TEXTS", 20)
    rows = around_one_template(70)
    rows += [(100 + i, f"{rows[0][1]} {i}") for i in range(3)] + [(200, rows[0][1])]
    shingled = {i: grams(t) for i, t in rows if i != 200}
    near = {i: sum(probability_jaccard(a, b) >= 0.8 for j, b in shingled.items() if j != i) for i, a in shingled.items()}
    got = {r["key"]: r["n_links"] for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got.pop(200) == near[0] and got == near

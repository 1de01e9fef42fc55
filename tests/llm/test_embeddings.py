from __future__ import annotations

import random

import numpy as np
import pytest

from newsloom.llm import embeddings
from newsloom.llm.links import components


def brute(rows, least=0.93):
    n = len(rows)
    unit = []
    for _, v, label in rows:
        ok = label is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)
        unit.append(np.asarray(v) / np.linalg.norm(v) if ok else None)
    root, degree = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = unit[i], unit[j]
            if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b) or a @ b < least:
                continue
            degree[i] += 1
            degree[j] += 1
            root[find(i)] = find(j)
    names = {}
    for i in range(n):
        names.setdefault(find(i), []).append(rows[i][0])
    out = []
    for i in range(n):
        known = [x for x in names[find(i)] if x is not None]
        name = min(known) if known else None
        out.append((rows[i][0], degree[i], name, rows[i][0] == name))
    return sorted(map(repr, out))


@pytest.mark.parametrize("block", [embeddings.BLOCK_ROWS, 16])
@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", block)
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 6))
    rows = []
    for i in range(260):
        v = centres[rng.integers(12)] * rng.uniform(0.1, 9) + rng.normal(size=6) * rng.choice([0.0, 0.2, 0.5])
        rows.append((i, [float(x) for x in v], int(rng.choice([1, 1, 1, 2]))))
    rows += [
        (300, None, 1), (301, [0.0] * 6, 1), (302, [float("nan")] + [1.0] * 5, 1), (303, [None] + [1.0] * 5, 1), (304, rows[0][1], None),
        (305, [float("inf")] + [1.0] * 5, 1), (306, [1.0, 2.0], 1), (307, [2.0, 4.0], 1), (308, [1e300] * 6, 1), (309, [1e-300] * 6, 1),
        (None, rows[0][1], rows[0][2]), (310, [], 1), rows[5], rows[5],
    ]
    random.Random(seed).shuffle(rows)
    small = [(a, [x * 1e-3 for x in b] if b and abs(b[0] or 0) > 1e200 else b, c) for a, b, c in rows]  # brute force must not overflow
    small = [(a, [1.0] * 6 if a in (308, 309) else b, c) for a, b, c in small]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    assert sorted(repr(tuple(r)) for r in embeddings.link_vectors(frame).collect()) == brute(small)


def test_empty_and_extra_columns(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0], 1, 5, "x")], "vec_id long, embedding array<float>, label int, rid int, dim string")
    assert [tuple(r) for r in embeddings.link_vectors(frame).collect()] == [(1, 0, 1, True)]
    assert embeddings.link_vectors(frame.where("false")).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(i, i + 1) for i in range(0, 40) if i % 11] + [(100, rng.randint(101, 130)) for _ in range(25)]
    links += [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(45)] + [(7, 7), (3, 2)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    wanted = sorted((i, find(i)) for a, b in links for i in (a, b) if a != b)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted(tuple(r) for r in got) == sorted(set(wanted))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from newsloom.llm import packing
from newsloom.llm.tokens import tokenizer_path

NAME = "word_bpe_49k.json"


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once_and_nearly_fills(seed):
    rng = random.Random(seed)
    counts = Counter(rng.choice([rng.randint(1, 64), rng.randint(1, 20), 64]) for _ in range(3000))
    patterns = packing.plan(dict(counts), 64)
    used = Counter()
    for pattern, times in patterns:
        assert sum(pattern) <= 64 and times > 0
        for size in pattern:
            used[size] += times
    assert used == counts
    least = -(-sum(k * v for k, v in counts.items()) // 64)
    assert sum(t for _, t in patterns) <= least * 1.02 + 1


def test_exact_complements_come_first():
    assert packing.plan({6: 2, 4: 2}, 10) == [([6, 4], 2)]
    assert packing.plan({5: 3, 3: 3, 2: 3}, 10) == [([5, 5], 1), ([5, 3, 2], 1), ([3, 3, 2, 2], 1)]
    assert packing.plan({}, 10) == []


def test_patterns_stay_few_when_pieces_grow():
    rng = random.Random(1)
    counts = {size: rng.randint(1, 9) for size in range(1, 300)}
    few = len(packing.plan(counts, 300))
    assert len(packing.plan({k: v * 100_000 for k, v in counts.items()}, 300)) <= max(600, 3 * few)


@pytest.mark.parametrize("ranked", [packing.RANKED_ROWS, 7])
def test_documents_are_packed_whole(docs, rows, monkeypatch, ranked):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "RANKED_ROWS", ranked)
    got = packing.pack_documents(docs, tokenizer_path(NAME), 64).collect()
    plain, wanted = Tokenizer.from_file(tokenizer_path(NAME)), []
    for row in rows:
        ids = np.asarray([*plain.encode(row[1] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        wanted += [(row[0], p, s, len(ids[s : s + 64]), zlib.crc32(ids[s : s + 64].tobytes())) for p, s in enumerate(range(0, len(ids), 64))]
    assert sorted(map(repr, wanted)) == sorted(repr(tuple(r)[:5]) for r in got)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by) <= -(-sum(r["length"] for r in got) // 64) + 2


def test_empty_table(no_docs):
    assert packing.pack_documents(no_docs, tokenizer_path(NAME)).count() == 0

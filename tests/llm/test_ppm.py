from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import pytest
from .conftest import sentence

from newsloom.llm import ppm

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def held(doc):
    return zlib.crc32(str("" if doc is None else doc).encode()) % 7 == 2


def tokens(text):
    return (text or "").encode().translate(LOWER).split()


class Plain:
    """The same model with dictionaries."""

    def __init__(self, learned):
        self.four, self.two, self.one, self.none = {}, {}, {}, Counter()
        for own in learned:
            for context, symbol in self.places(own):
                self.four.setdefault(context, Counter())[symbol] += 1
                self.two.setdefault(context[-2:], Counter())[symbol] += 1
                self.one.setdefault(context[-1:], Counter())[symbol] += 1
                self.none[symbol] += 1

    @staticmethod
    def places(own):
        text = b" " * 4 + b"".join(w + b" " for w in own)
        return [(text[i - 4 : i], text[i] if i < len(text) else 256) for i in range(4, len(text) + 1)]

    def probability(self, context, symbol):
        p, excluded = 1.0, set()
        for counts in (self.four.get(context, {}), self.two.get(context[-2:], {}), self.one.get(context[-1:], {}), self.none):
            open_ = {s: c for s, c in counts.items() if s not in excluded}
            if open_:
                n, t = sum(open_.values()), len(open_)
                if symbol in open_:
                    return p * open_[symbol] / (n + t)
                p *= t / (n + t)
            excluded = excluded | set(counts)
        return p / max(1, 257 - len(self.none))

    def score(self, own):
        return sum(math.log10(self.probability(*place)) for place in self.places(own))


def check(got, rows):
    learned = [tokens(t) for d, t, *_ in rows if not held(d)]
    counts, ends = Counter(w for own in learned for w in own), len(learned)
    total, kinds = sum(counts.values()) + ends, len(counts) + (1 if ends else 0)
    plain, wanted = Plain(learned), Counter()
    for doc, text, *_ in rows:
        own = tokens(text)
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in own) + math.log10((ends + 1) / (total + kinds + 1))
        score = plain.score(own)
        known = sum(counts[w] > 0 for w in own) + (1 if ends else 0)
        wanted[doc, held(doc), len(own) + 1, known, total, round(base, 5), round(score, 5)] += 1
    assert Counter((*tuple(r)[:5], round(r["base_score"], 5), round(r["score"], 5)) for r in got) == wanted


@pytest.mark.parametrize("small", [False, True])
def test_equals_plain_model(docs, rows, monkeypatch, small):
    if small:
        for name, value in (("BUCKET_CHARS", 3000), ("BATCH_BYTES", 2500), ("CHUNK", 700), ("MERGE", 100), ("_TABLE_ROWS", 30)):
            monkeypatch.setattr(ppm, name, value)
    check(ppm.score_texts(docs).collect(), rows)


def test_nothing_to_learn_from_and_empty(spark, no_docs):
    own = [i for i in range(60) if held(i)][:3]
    rows = [(i, t) for i, t in zip(own, ["a b", None, "Zz"])]
    check(ppm.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)
    assert ppm.score_texts(no_docs).count() == 0


def test_symbols_after_a_context_sum_to_at_most_one():
    rng = random.Random(4)
    learned = [tokens(sentence(rng, 30)) for _ in range(20)]
    plain = Plain(learned)
    for context in [b"    ", b"zzzz", *rng.sample(sorted(plain.four), 30)]:
        assert 0.9 < sum(plain.probability(context, s) for s in range(257)) <= 1 + 1e-9


def test_word_order_changes_the_score(spark):
    rows = [(i, "the cat sees a dog") for i in range(20)]
    others = [i for i in range(100, 300) if held(i)][:2]
    rows += [(others[0], "the cat sees a dog"), (others[1], "dog a sees cat the")]
    got = {r["doc_id"]: r["score"] for r in ppm.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[others[0]] > got[others[1]] + 1


def test_learned_text_is_likelier(spark):
    """Words of the corpus, in any order, cost less than the same letters shuffled."""
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice(["ba", "ko", "tri", "len", "su"]) for _ in range(3)) for _ in range(200)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(60))) for i in range(300)]
    mixed = list("".join(rng.choice(vocabulary) for _ in range(60)))
    rng.shuffle(mixed)
    other = next(i for i in range(1000, 2000) if held(i))
    rows.append((other, " ".join("".join(mixed[i : i + 7]) for i in range(0, len(mixed), 7))))
    got = {r["doc_id"]: r["score"] / r["n_tokens"] for r in ppm.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    usual = [v for k, v in got.items() if held(k) and k != other]
    assert got[other] < 2 * min(usual)

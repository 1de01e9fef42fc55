from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from newsloom.llm import alignment
from newsloom.llm.alignment import align_batch, encoders
from newsloom.llm.tokens import tokenizer_path
from tests.llm.test_tokens import TEXTS

PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
MORE = ["a▁b", "nul \x00 x", "<s> </s> <unk> <0x41>", "  two  blanks ", "\n\n x\n \n", "tab\tx", "ﬁ ½ ①", "x" * 200 + " " + "y z " * 40, " ", "é" * 90]


def plain(texts):
    """Token by token, with nothing shared between texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(PATHS[0])
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    names = {i: t for t, i in a_side.get_vocab().items()}
    seen = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    unseen = [b for b in range(256) if b not in seen]
    letters = {chr(b): b for b in seen} | {chr(256 + n): b for n, b in enumerate(unseen)}
    rows, counts = [], Counter()
    for text in texts:
        spans = [[], []]
        if text:
            wanted = (" " + text).encode()
            a = a_side.encode(" " + text, add_special_tokens=False).ids
            b = b_side.encode(text)
            pieces = [(i, b_side.id_to_piece(i)) for i in b]
            both = [
                [(i, bytes(letters[c] for c in names[i])) for i in a],
                [(i, bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces],
            ]
            if all(b"".join(x for _, x in side) == wanted for side in both):
                for side, tokens in enumerate(both):
                    at = 0
                    for i, raw in tokens:
                        spans[side].append((i, at, at + len(raw)))
                        at += len(raw)
        links, first = [], 0
        for i, low, high in spans[0]:
            while first < len(spans[1]) and spans[1][first][2] <= low:
                first += 1
            for j, start, end in spans[1][first:]:
                if start >= high:
                    break
                links.append((i, j))
        counts.update(links)
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, low = [], 0
        for high in ends:
            groups.append("|".join(",".join(str(i) for i, s, _ in side if low <= s < high) for side in spans))
            low = high
        rows.append((links, len(spans[0]), len(spans[1]), groups))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    out = []
    for links, n_a, n_b, groups in rows:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        top = sum(counts[x] == best[x[1]] for x in links)
        out.append((n_a, n_b, len(groups), len(links), top, sum(counts[x] for x in links), digest))
    return out


@pytest.mark.parametrize("most", [1, 7, 10**6])
def test_batches_equal_plain_alignment(most, rows):
    texts = TEXTS + MORE + [r[1] or "" for r in rows[:30]]
    counts, digests, codes, links = align_batch(texts, encoders(*PATHS), most)
    want = plain(texts)
    for n, (text, w) in enumerate(zip(texts, want)):
        got = (*[int(counts[c][n]) for c in ("n_a", "n_b", "n_groups", "n_links")], digests[n])
        assert got == (*w[:4], w[-1]), text
    assert links.sum() == sum(w[3] for w in want) and (codes[1:] > codes[:-1]).all()


@pytest.mark.parametrize("hot_rows", [10**6, 1])
def test_documents_equal_plain_alignment(spark, docs, rows, hot_rows):
    got = alignment.align(docs, *PATHS, batch_bytes=3000, hot_rows=hot_rows)
    got = sorted((tuple(r) for r in got.collect()), key=repr)
    want = sorted(((r[0], *w) for r, w in zip(rows, plain([r[1] for r in rows]))), key=repr)
    assert got == want


def test_clashing_columns_and_odd_texts(spark):
    texts = [None, "", *TEXTS, *MORE]
    rows = [(i, t, "x", 1, 2) for i, t in enumerate(texts)] + [(None, "twice", "x", 1, 2)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, `key` string, n_a int, batch int")
    got = sorted((tuple(r) for r in alignment.align(docs, *PATHS).collect()), key=repr)
    assert got == sorted(((r[0], *w) for r, w in zip(rows, plain([r[1] for r in rows]))), key=repr)


def test_very_many_short_texts_end_a_batch(spark):
    docs = spark.range(60_000).selectExpr("id as doc_id", "if(id % 2 = 0, null, 'a') as text").coalesce(1)
    got = alignment.align(docs, *PATHS)
    assert {tuple(r) for r in got.groupBy("n_a", "n_best", "count_sum").count().collect()} == {(0, 0, 0, 30_000), (1, 1, 30_000, 30_000)}


def test_empty_table(spark, no_docs):
    assert alignment.align(no_docs, *PATHS).count() == 0

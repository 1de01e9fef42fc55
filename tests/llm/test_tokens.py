from __future__ import annotations

import zlib

import numpy as np
import pytest

from newsloom.llm import token_files
from newsloom.llm.tokens import Encoder, tokenizer_path

BYTES, WORDS = "byte_bpe_50k.json", "word_bpe_49k.json"
TEXTS = [
    "", " ", "\n", "a", " a  b", "a\n\nb\n c \n", "don't we'll I'M 'S", "x\ty \t z", " a b", "É é́ ́x",
    "<|endoftext|>a <|endoftext|> b<|ENDOFTEXT|>", "ΑΣ Σ aα.bβ İx", "é² n.º 3rd (a) [b] {c}~", "日本語 テスト", "\x1c \x85 z", "A" * 300,
    "tail  ", "snake_case-word/path.ext#1", "😀 ok 😀😀",
]


@pytest.mark.parametrize(("name", "keeps"), [(BYTES, True), (WORDS, False)])
def test_encoder_equals_the_tokenizer(name, keeps, rows):
    from tokenizers import Tokenizer

    encoder, plain = Encoder(tokenizer_path(name), keeps, cache_size=50), Tokenizer.from_file(tokenizer_path(name))
    texts = TEXTS + [r[1] for r in rows if r[1]]
    for _ in range(2):
        for text, got in zip(texts, encoder.encode(texts)):
            assert np.frombuffer(got, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def _wanted(rows):
    from tokenizers import Tokenizer

    plain, start, out = Tokenizer.from_file(tokenizer_path(BYTES)), 0, []
    for row in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.asarray([*plain.encode(row[1] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        out.append((row[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_hold_every_document_in_order(spark, docs, rows, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs, path, tokenizer_path(BYTES), files=5)
    got = [tuple(r) for r in token_files.token_positions(spark, path).collect()]
    assert sorted(got, key=lambda r: r[1]) == _wanted(rows)


def test_scan_of_some_ids_is_pushed_down(spark, docs, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs, path, tokenizer_path(BYTES), files=5)
    some = token_files.read_tokens(spark, path, (10, 20))
    assert sorted(r["doc_id"] for r in some.select("doc_id").collect()) == list(range(10, 21))
    plan = some._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(doc_id,10)" in plan
    assert token_files.read_tokens(spark, path, (12, 12)).count() == 1


def test_bloom_filter_is_in_the_files(spark, docs, tmp_path):
    import pyarrow.orc as orc

    path = tmp_path / "tokens"
    token_files.write_tokens(docs, str(path), tokenizer_path(BYTES))
    file = orc.ORCFile(next(f for f in path.iterdir() if f.suffix == ".orc"))
    assert file.row_index_stride == token_files.INDEX_STRIDE and file.nstripes >= 1


def test_empty_table(spark, no_docs, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(no_docs, path, tokenizer_path(BYTES))
    assert token_files.token_positions(spark, path).count() == 0

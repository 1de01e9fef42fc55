"""Two tokenizers' cuts of the same texts: which tokens overlap, and where both cut."""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.common import batches, doc_key, key_to_id, spool, whole_text
from newsloom.llm.exchange import batch_id, join_bytes, pack_refs, split_bytes, unpack_refs
from newsloom.llm.tokens import _byte_letters, tokenizer_path
from newsloom.operators.joins import HOT_ROWS, HOT_SHARE, salted_join

BATCH_BYTES = 4 << 20
BATCH_ROWS = 20_000
#: Tokens of each side that are aligned at once; longer texts are cut where both sides cut.
ALIGN_TOKENS = 400_000
_PIECES = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_OTHER_SPACE = re.compile(r"[^\S \n]")
_LONG = 64
_CACHED = 400_000
_loaded: dict[tuple[str, str], TwoEncoders] = {}

_COLUMNS = ("key", "n_a", "n_b", "n_groups", "n_links")
_PARTS = (
    "batch long, " + ", ".join(f"{c} array<long>" for c in _COLUMNS)
    + ", groups_sha256 array<string>, refs binary, pairs array<long>, links array<long>"
)
_NAMES = ["batch", *_COLUMNS, "groups_sha256", "refs", "pairs", "links"]
_RESULT = [*_COLUMNS, "n_best", "count_sum", "groups_sha256"]
_RESULT_TYPES = ", ".join(f"{c} long" for c in _RESULT[:-1]) + ", groups_sha256 string"


class TwoEncoders:
    """Token ids of both sides for whole texts, and the bytes of every token.

    A side's ids are those of the space and the text. A text is cut before
    each run of blanks and line breaks that follows another character: there
    the byte-level tokenizer begins a word, and no piece of the other one has a
    blank or line break behind anything else (checked when it is loaded). So
    the ids of the pieces put together are the ids of the text, and pieces
    recur. Texts with other white space are encoded whole.
    """

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        letters = {letter: byte for byte, letter in _byte_letters().items()}
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        if max(self.a.get_vocab_size(), self.b.get_piece_size()) > 1 << 16:
            raise ValueError("a vocabulary has more than 65,536 ids")
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.length_a = np.asarray([len(x) for x in self.bytes_a], dtype=np.int64)
        self.length_b = np.asarray([len(x) for x in self.bytes_b], dtype=np.int64)
        self.cuts = not any("\n" in p or re.search("[^▁]▁", p) for p in pieces)
        self.lead = self.b.encode("\n")
        self.cache: dict[str, tuple[bytes, bytes] | None] = {}

    def whole(self, text: str) -> tuple[bytes, bytes] | None:
        """Both sides' ids of a text, encoded at once; None if a side does not give the text back."""
        wanted = (" " + text).encode()
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text, num_threads=1)
        if b"".join(map(self.bytes_a.__getitem__, a)) != wanted or b"".join(map(self.bytes_b.__getitem__, b)) != wanted:
            return None
        return np.asarray(a, dtype="<u2").tobytes(), np.asarray(b, dtype="<u2").tobytes()

    def _learn(self, pieces: list[str]) -> dict[str, tuple[bytes, bytes] | None]:
        """Both sides' ids of pieces; None for one that a side does not give back."""
        found, lead = {}, len(self.lead)
        a = self.a.encode_batch(pieces, add_special_tokens=False)
        b = self.b.encode(["\n" + p for p in pieces], num_threads=1)  # so that no space is put before the piece
        for piece, x, y in zip(pieces, a, b):
            raw, x = piece.encode(), x.ids
            same = y[:lead] == self.lead and b"".join(map(self.bytes_a.__getitem__, x)) == raw
            y = y[lead:]
            if same and b"".join(map(self.bytes_b.__getitem__, y)) == raw:
                found[piece] = (np.asarray(x, dtype="<u2").tobytes(), np.asarray(y, dtype="<u2").tobytes())
            else:
                found[piece] = None
        return found

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """For each text the ids of both sides as unsigned 16-bit integers, or None."""
        cut = [None if not t or not self.cuts or _OTHER_SPACE.search(t) else _PIECES.findall(" " + t) for t in texts]
        if len(self.cache) > _CACHED:
            self.cache = {}
        new = set().union(*[c for c in cut if c]) - self.cache.keys()
        found = self._learn(sorted(new))
        long = {p: found.pop(p) for p in [p for p in found if len(p) > _LONG]}
        self.cache.update(found)
        out = []
        for text, pieces in zip(texts, cut):
            if not text:
                out.append(None)
                continue
            ids = None if pieces is None else [long[p] if p in long else self.cache[p] for p in pieces]
            if ids is None or None in ids:
                out.append(self.whole(text))
            else:
                out.append((b"".join([x for x, _ in ids]), b"".join([y for _, y in ids])))
        return out


def encoders(byte_path: str, piece_path: str) -> TwoEncoders:
    """The worker's encoders for two tokenizer files."""
    key = (byte_path, piece_path)
    if key not in _loaded:
        _loaded[key] = TwoEncoders(byte_path, piece_path)
    return _loaded[key]


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray, a_doc: np.ndarray, b_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of an A and a B token whose byte ranges overlap.

    Both sides cover the same bytes without gaps, document after document.
    Each token's start is looked up among the other side's starts of the same
    document, backwards, which gives the token that covers it. Two ranges
    overlap where one covers the other's start; where the starts are the same,
    both directions find the pair and one is kept.
    """
    a_start = np.append(0, a_ends[:-1])
    b_start = np.append(0, b_ends[:-1])
    left = pd.DataFrame({"start": a_start, "doc": a_doc, "i": np.arange(len(a_ends), dtype=np.int32)})
    right = pd.DataFrame({"start": b_start, "doc": b_doc, "j": np.arange(len(b_ends), dtype=np.int32)})
    one = pd.merge_asof(left, right, on="start", by="doc")
    other = pd.merge_asof(right, left, on="start", by="doc")
    i, j = other["i"].to_numpy(), other["j"].to_numpy()
    new = a_start[i] != b_start[j]
    return np.concatenate([one["i"].to_numpy(), i[new]]), np.concatenate([one["j"].to_numpy(), j[new]])


class _Texts:
    """Number texts of both sides with what follows an id in the written groups."""

    def __init__(self, sizes: tuple[int, int]):
        names = [np.asarray([str(i) for i in range(n)], dtype=object) for n in sizes]
        self.inner = [n + "," for n in names]
        self.last = [names[0] + "|", names[1] + ";"]


_texts: dict[tuple[int, int], _Texts] = {}


def _groups(ids: list[np.ndarray], ends: list[np.ndarray], sizes: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where both sides end a token (bool per A token), and the written groups, with the place of each A token in them."""
    if sizes not in _texts:
        _texts[sizes] = _Texts(sizes)
    both = [np.isin(mine, other, assume_unique=True) for mine, other in (ends, ends[::-1])]
    group = [np.cumsum(b) - b for b in both]
    count = int(both[0].sum())
    before_b = np.searchsorted(group[1], np.arange(count))
    until_a = np.searchsorted(group[0], np.arange(count), side="right")
    place = [np.arange(len(ids[0])) + before_b[group[0]], np.arange(len(ids[1])) + until_a[group[1]]]
    words = np.empty(len(ids[0]) + len(ids[1]), dtype=object)
    for side in (0, 1):
        table = _texts[sizes]
        words[place[side]] = np.where(both[side], table.last[side][ids[side]], table.inner[side][ids[side]])
    return both[0], words, place[0]


def _chunks(a_ends: np.ndarray, b_ends: np.ndarray, most: int) -> Iterator[tuple[slice, slice]]:
    """Both sides' tokens in parts of about ``most``, cut where both end; a part with no such place stays whole."""
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    a_at, b_at = np.searchsorted(a_ends, common) + 1, np.searchsorted(b_ends, common) + 1
    a, b, last = 0, 0, len(common) - 1
    while a < len(a_ends):
        pick = min(max(np.searchsorted(a_at, a + most, side="right") - 1, np.searchsorted(a_at, a, side="right")), last)
        yield slice(a, a_at[pick]), slice(b, b_at[pick])
        a, b = a_at[pick], b_at[pick]


def align_batch(
    texts: list[str], both: TwoEncoders, most: int = ALIGN_TOKENS
) -> tuple[dict[str, np.ndarray], list[str], np.ndarray, np.ndarray]:
    """Counts per text, the digest of its groups, and the id pairs of each text.

    The pairs are distinct ``text << 32 | a << 16 | b``, ascending, with the number of links of each.
    """
    coded = both.encode(texts)
    counts = {c: np.zeros(len(texts), dtype=np.int64) for c in _COLUMNS[1:]}
    ids = [np.frombuffer(b"".join([c[s] for c in coded if c]), dtype="<u2") for s in (0, 1)]
    for side, name in enumerate(("n_a", "n_b")):
        counts[name][:] = [len(c[side]) // 2 if c else 0 for c in coded]
    doc = [np.repeat(np.arange(len(texts)), counts[n]) for n in ("n_a", "n_b")]
    ends = [np.cumsum(both.length_a[ids[0]]), np.cumsum(both.length_b[ids[1]])]
    digests: list = [None] * len(texts)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for x, y in _chunks(*ends, most):
        base = ends[0][x.start - 1] if x.start else 0
        parts, a_doc = [ids[0][x], ids[1][y]], doc[0][x]
        a_ends, b_ends = ends[0][x] - base, ends[1][y] - base
        i, j = overlaps(a_ends, b_ends, a_doc, doc[1][y])
        pair = (parts[0][i].astype(np.uint64) << np.uint64(16)) | parts[1][j]
        found.append(np.unique((a_doc[i].astype(np.uint64) << np.uint64(32)) | pair, return_counts=True))
        common, words, place = _groups(parts, [a_ends, b_ends], (len(both.bytes_a), len(both.bytes_b)))
        counts["n_groups"] += np.bincount(a_doc[common], minlength=len(texts))
        counts["n_links"] += np.bincount(a_doc[i], minlength=len(texts))
        firsts = np.flatnonzero(np.append(True, a_doc[1:] != a_doc[:-1]))
        for first, low, high in zip(firsts, place[firsts], [*place[firsts[1:]], len(words)]):
            text, written = a_doc[first], "".join(words[low:high])[:-1].encode()
            if digests[text] is None:
                digests[text] = hashlib.sha256(written)
            else:  # a long text goes on
                digests[text].update(b";" + written)
    codes, links = _summed(found)
    return counts, [d.hexdigest() if d else "" for d in digests], codes, links


def _summed(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and the sum of their counts."""
    if len(found) == 1:
        return found[0]
    codes = np.concatenate([np.zeros(0, dtype=np.uint64), *[c for c, _ in found]])
    counts = np.concatenate([np.zeros(0, dtype=np.int64), *[n for _, n in found]])
    distinct, place = np.unique(codes, return_inverse=True)
    sums = np.zeros(len(distinct), dtype=np.int64)
    np.add.at(sums, place, counts)
    return distinct, sums


def align(
    docs: DataFrame,
    byte_tokenizer: str,
    piece_tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    batch_bytes: int = BATCH_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Align a byte-level tokenizer (A) with a sentencepiece one (B) in every whole text.

    A encodes a space and the text, B the text, to which it adds the space
    itself. Returns per document ``id_column``, ``n_a`` and ``n_b`` tokens,
    ``n_groups`` between the places where both end a token, ``n_links``
    overlapping A-B pairs, ``n_best`` links whose id pair has the most links
    of all pairs of its B id in the corpus (ties included), ``count_sum``,
    the sum over links of their pair's links in the corpus, and
    ``groups_sha256``.

    A null or empty text, and one that a side does not give back byte for
    byte, has no tokens: zeros and an empty digest. A null id stays null,
    repeated rows and ids all give a row, ties count as best, other columns
    are not looked at, and an empty table gives no rows. Texts may have any
    length: one beyond ``batch_bytes`` is a batch alone, and is aligned in
    parts cut where both sides cut. Both vocabularies have at most 65,536 ids.

    A task adds up a batch's links by id pair; only these sums are shuffled,
    and what they come to in the corpus goes back to the batch.
    """

    def measure(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = encoders(byte_tokenizer, piece_tokenizer)
        for number, table in enumerate(batches(stream, "text", batch_bytes, BATCH_ROWS)):
            keys = table["key"].to_numpy()
            counts, digests, codes, links = align_batch(table["text"].to_pylist(), both)
            pairs, refs = np.unique(codes & np.uint64(0xFFFFFFFF), return_inverse=True)
            sums = np.zeros(len(pairs), dtype=np.int64)
            np.add.at(sums, refs, links)
            sizes = np.bincount((codes >> np.uint64(32)).astype(np.int64), minlength=len(keys)).astype("<u4")
            packed = zlib.compress(join_bytes(sizes, pack_refs(refs), links.astype("<u4")), 1)
            row = [batch_id(keys, number), keys, *counts.values(), digests, packed, pairs.astype(np.int64), sums]
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=_NAMES)

    rows = docs.select(doc_key(id_column).alias("key"), whole_text(text_column).alias("text"))
    measured = spool(rows.mapInArrow(measure, _PARTS), "aligned")
    asked = measured.select("batch", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select("batch", "x.*")
    totals = spool(asked.groupBy("pairs").agg(F.sum("links").alias("total"), F.count("*").alias("batches")), "pairs")
    most = totals.groupBy((F.col("pairs") % 65536).alias("b")).agg(F.max("total").alias("most"))
    scored = (  # a row for each B id, 65,536 at most
        totals.withColumn("b", F.col("pairs") % 65536)
        .join(F.broadcast(most), "b")
        .select("pairs", "total", (F.col("total") == F.col("most")).alias("best"))
    )
    asked_rows = totals.agg(F.sum("batches").alias("rows")).scalar()
    limit = F.greatest(F.lit(hot_rows).cast("double"), asked_rows * F.lit(HOT_SHARE))
    hot = totals.withColumn("limit", limit).where(F.col("batches") > F.col("limit"))
    hot = hot.select("pairs", F.ceil(F.col("batches") / F.col("limit")).cast("int").alias("_parts"))
    asking = asked.select(F.col("batch").alias("asked_by"), "pairs")
    answers = salted_join(asking, scored, ["pairs"], "inner", hot=hot)
    own = measured.drop("pairs", "links")

    def finish(own: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.argsort(answers["pairs"].to_numpy())
        total, best = answers["total"].to_numpy()[order], answers["best"].to_numpy()[order].astype(np.int64)
        sizes, refs, links = split_bytes(zlib.decompress(own["refs"][0].as_py()), "<u4", np.uint8, "<u4")
        refs, links = unpack_refs(refs), links.astype(np.int64)
        ends = np.cumsum(sizes.astype(np.int64))
        out = [own[c].combine_chunks().flatten() for c in _COLUMNS]
        for values in (best, total):
            running = np.append(0, np.cumsum(values[refs] * links))
            out.append(pa.array(running[ends] - running[ends - sizes]))
        return pa.Table.from_arrays([*out, own["groups_sha256"].combine_chunks().flatten()], names=_RESULT)

    done = own.groupBy("batch").cogroup(answers.groupBy("asked_by")).applyInArrow(finish, _RESULT_TYPES)
    return done.select(key_to_id().alias(id_column), *_RESULT[1:])


def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tokenizers aligned in all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return align(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))

"""Token ids of whole texts, one worker-wide cache of encoded pieces per tokenizer."""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_MARKS = r"!-&(-/:-@\[-`{-~"
_PIECE = rf"[{_LETTERS}]+(?=[\x00-@\[-`{{-~]|\Z)|[{_MARKS}]+(?=[ \n]|\Z)|[^ \n]+"
_PIECES = re.compile(rf"[ \n]*(?:{_PIECE})|[ \n]+")
_WORD_PIECES = re.compile(_PIECE)
_OTHER_SPACE = re.compile(r"[^\S \n]")
_LONG = 64


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: itself if it can be seen, else one from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTE_LETTERS = _byte_letters()
_loaded: dict[tuple[str, bool], Encoder] = {}


class Encoder:
    """Encodes texts as the tokenizer does, piece by piece.

    A text is cut before each run of blanks and line breaks that follows
    another character, and behind letters that an ASCII mark, digit or blank
    follows. Byte-level and word-level tokenizers both begin a new word there,
    so the ids of the pieces put together are the ids of the text; pieces recur
    and are encoded once. A text with other white space is encoded whole where
    the tokenizer keeps white space; where it drops it and lower-cases, the
    pieces are lower-cased first, unless the text may hold a special token or a
    letter whose lower case depends on what follows. The cache holds at most
    ``cache_size`` pieces and is emptied when full.
    """

    def __init__(self, path: str, keeps_space: bool, cache_size: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.keeps_space, self.cache_size = keeps_space, cache_size
        self.cache = _Pieces(self)

    def ids(self, text: str) -> bytes:
        """The tokenizer's ids of a text, not cut."""
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        if len(self.cache) > self.cache_size:
            self.cache.clear()
        find, encoded = self.cache.__getitem__, []
        for text in texts:
            if self.keeps_space:
                pieces = _PIECES.findall(text)
            else:
                plain = "<|" in text or "\u03a3" in text
                pieces = _WORD_PIECES.findall(text if plain else text.lower())
            try:
                encoded.append(b"".join(map(find, pieces)))
            except _OtherSpace:
                encoded.append(self.ids(text))
        return encoded


class _OtherSpace(Exception):
    """A piece holds white space that may belong to its neighbour's run."""


class _Pieces(dict):
    """Pieces with their ids; a new one is encoded when it is asked for."""

    def __init__(self, owner: Encoder):
        super().__init__()
        self.owner = owner

    def __missing__(self, piece: str) -> bytes:
        if self.owner.keeps_space and _OTHER_SPACE.search(piece):
            raise _OtherSpace
        word = piece[1:] if piece.startswith(" ") else piece
        # one word of the tokenizer's, with no accents to put together and no case to change
        if word.isalpha() and max(word) < "\u0250" and (self.owner.keeps_space or word.islower()):
            letters = piece.encode().decode("latin-1").translate(_BYTE_LETTERS)
            ids = array("I", [t.id for t in self.owner.model.tokenize(letters)]).tobytes()
        else:
            ids = self.owner.ids(piece)
        if len(piece) <= _LONG:
            self[piece] = ids
        return ids


def encoder(path: str, keeps_space: bool) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    key = (path, keeps_space)
    if key not in _loaded:
        _loaded[key] = Encoder(path, keeps_space)
    return _loaded[key]


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file is."""
    import public_tokenizers

    return public_tokenizers.path(name)

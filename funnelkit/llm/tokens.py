"""Token ids of whole texts with a public tokenizer file.

A text of ASCII and Latin-1 letters only is cut by the public vocabularies' own
pre-tokenisation pattern, and each piece goes to the library's BPE model once:
pieces repeat, and one in the cache is not encoded again.  Any other text, and
every text for a vocabulary that drops white space, is cut where a non-space character is followed by white space; both vocabularies
pre-tokenise so that no token crosses such a place and no look-around sees past
it, so its ids are the ids of these chunks in a row, each by its pieces or, with
other characters, through the whole library pipeline.  A text with
``\\x1c-\\x1f`` (white space to Python, not to the tokenizer) is encoded whole,
and so is one that holds the content of an added token of the file, which the
library finds before it pre-tokenises, and every text with a file whose ids on
``_PROBE`` the pattern does not give.

The tokenizer file is read on the driver (its size is checked) and sent as one
broadcast; the caches live in that broadcast's copy in each Python worker and
hold at most ``CACHE_ENTRIES`` pieces and chunks, which bounds memory and never
changes an id.
"""

from __future__ import annotations

import os
import re
from array import array
from operator import itemgetter

import numpy as np
from pyspark.sql import SparkSession

CACHE_ENTRIES, CACHED_LENGTH = 1 << 19, 64
VOCABULARY_BOUND = 64 << 20
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_SPACED = re.compile(r"\s*\S+|\s+")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(f"[ \t\n\r!-~{_LETTERS}]*")

# The two files' pre-tokenisation patterns, for the characters of _PLAIN.
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
_SPACED_PIECE = re.compile(rf"{_ENDINGS}| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+")
_WORD_PIECE = re.compile(rf"{_ENDINGS}|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+")
_PROBE = " Don't  we'll\t\tI'M 'sure 120x7 3.14,0 a_b-c (é)Àß ÿ\n\nZwei!? ..$$%%\r\n don'trust'd 's It's|x@y.z #1&2 {}[]<>~`^"


def _byte_letters() -> dict[int, int]:
    """Byte-level BPE writes bytes without a visible Latin-1 character as the
    characters from 256 on, in order."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in seen)}


class PieceIds(dict):
    """Piece -> its ids as little-endian integers, filled as pieces are met."""

    def __init__(self, tokenizer, kind: str):
        super().__init__()
        self.model, self.letters = tokenizer.model.tokenize, _byte_letters()
        self.space, self.code = chr(self.letters[32]), {2: "H", 4: "I"}[np.dtype(kind).itemsize]

    def __missing__(self, piece: str) -> bytes:
        if not piece.isascii() or piece[0] in "\t\n\r" or piece.isspace():
            letters = piece.encode().decode("latin-1").translate(self.letters)
        else:
            letters = piece.replace(" ", self.space)
        found = array(self.code, [t.id for t in self.model(letters)]).tobytes()
        if len(self) < CACHE_ENTRIES and len(piece) <= CACHED_LENGTH:
            self[piece] = found
        return found


def _joined(keys: list[str], known: dict) -> bytes:
    return b"".join(itemgetter(*keys)(known)) if len(keys) > 1 else known[keys[0]] if keys else b""


class ChunkIds(dict):
    """Chunk -> its ids as little-endian integers, filled as chunks are met."""

    def __init__(self, tokenizer, spaces: bool, kind: str):
        super().__init__()
        self.tokenizer, self.spaces, self.kind = tokenizer, spaces, kind
        self.plain = _PLAIN.fullmatch
        added = list(tokenizer.get_added_tokens_decoder().values())
        self.added = [t.content for t in added if not t.normalized]
        # matched after normalisation, so without regard to case; too many found cost only time
        self.odd = re.compile("|".join([_ODD_SPACE.pattern, *(re.escape(t.content) for t in added if t.normalized)]), re.I).search
        self.pieces, self.of_piece = (_SPACED_PIECE if spaces else _WORD_PIECE).findall, PieceIds(tokenizer, kind)
        self.cut = _SPACED.findall if spaces else str.split
        try:
            self.fits = self.by_pieces(_PROBE) == self.whole(_PROBE)
        except Exception:  # the model knows no byte-level pieces
            self.fits = False

    def by_pieces(self, text: str) -> bytes:
        return _joined(self.pieces(text if self.spaces else text.lower()), self.of_piece)

    def __missing__(self, chunk: str) -> bytes:
        found = self.by_pieces(chunk) if self.plain(chunk) else self.whole(chunk)
        if len(self) < CACHE_ENTRIES and len(chunk) <= CACHED_LENGTH:
            self[chunk] = found
        return found

    def uncut(self, text: str) -> bool:
        return any(map(text.__contains__, self.added)) or self.odd(text) is not None

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def ids(self, text: str) -> bytes:
        if not self.fits or self.uncut(text):
            return self.whole(text)
        # without white space tokens a word and its marks are one look-up as a chunk
        return self.by_pieces(text) if self.spaces and self.plain(text) else _joined(self.cut(text), self)


def shared_tokenizer(spark: SparkSession, path: str, spaces: bool):
    """Broadcast state of the tokenizer file at ``path``; ``spaces``: white
    space makes tokens of its own and letters keep their case."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if len(text) > VOCABULARY_BOUND:
        raise ValueError(f"tokenizer file of {len(text)} characters; the bound is {VOCABULARY_BOUND}")
    return spark.sparkContext.broadcast({"json": text, "spaces": spaces})


def encode(state: dict, texts: list[str]) -> list[np.ndarray]:
    """The ids of each text as unsigned 32-bit integers."""
    if "known" not in state:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(state["json"])
        kind = "<u2" if tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        state["known"] = ChunkIds(tokenizer, state["spaces"], kind)
    known = state["known"]
    return [np.frombuffer(known.ids(t), known.kind).astype("<u4") for t in texts]

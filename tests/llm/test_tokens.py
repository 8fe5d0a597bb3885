"""The ids of whole texts are those of the tokenizer library, for both vocabularies."""

import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from funnelkit.llm import tokens

LETTERS = "abcXYZ012.,;:!?'\"-_|$%&#*()é È ßÿ\t\n\r  \x1c\x85  İẞﬁ漢字🙂é"


def _texts():
    rng = random.Random(9)
    texts = ["", " ", "\n\n", "word", " word", "word,word word", "don't we'll I'M", "end <|endoftext|> go", "<|STARTOFTEXT|> x",
             "a" * 200, "x " * 3000, "  two  spaces\n\n\nlines \t", "Ünï cödé ÿ ß", "12 345 6,789.01", "$$$ %%% ---"]
    texts += ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(60))) for _ in range(3000)]
    given = duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet' WHERE text IS NOT NULL ORDER BY doc_id LIMIT 400").fetchall()
    return texts + [r[0] for r in given]


@pytest.mark.parametrize("name, spaces", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_ids_are_those_of_the_library(monkeypatch, name, spaces):
    text = open(public_tokenizers.path(name), encoding="utf-8").read()
    library = Tokenizer.from_str(text)
    texts = _texts()
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    state = {"json": text, "spaces": spaces}
    assert [x.tolist() for x in tokens.encode(state, texts)] == expected
    assert [x.tolist() for x in tokens.encode(state, texts)] == expected  # from the cache
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 50)  # caches that are full at once
    assert [x.tolist() for x in tokens.encode({"json": text, "spaces": spaces}, texts)] == expected
    assert state["known"].fits
    state["known"].fits = False  # a file with other patterns: the library pipeline
    assert [x.tolist() for x in tokens.encode(state, texts)] == expected
    assert all(x.dtype == np.dtype("<u4") for x in tokens.encode(state, ["a", ""]))


def test_a_file_with_other_patterns_is_not_cut():
    text = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    swapped = tokens.ChunkIds(Tokenizer.from_str(text), False, "<u2")  # the other vocabulary's pattern
    assert not swapped.fits and swapped.ids(" Don't  stop") == swapped.whole(" Don't  stop")

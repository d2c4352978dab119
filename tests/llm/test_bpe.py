import sys
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from driftline.llm import bpe, common, token_store
from driftline.llm.bpe import VOCABULARY, bpe_encode_decode, vocabulary

PATH = public_tokenizers.path(VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def same(library, texts):
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        ids = memoryview(vocabulary(PATH).encode(text)).cast("i").tolist()
        assert ids == want.ids, repr(text)
        assert library.decode(want.ids, skip_special_tokens=False) == vocabulary(PATH).decode(ids)


def test_every_character(library):
    same(library, [f"a{chr(c)}b {chr(c)}'s" for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) not in ("Cn", "Cs")])


def test_special_cases(library):
    same(library, ["", " ", "it's I'LL", "x" * 3000, "ab" * 2000, "<|endoftext|>a<|startoftext|> <|b", "ΑΣ Σ", "é é", "a\x1cb c", "12 345", "a. b, c.d, e., f,", "x.\n", "é. ."])


def test_long_texts_in_parts(library, monkeypatch):
    texts = ["word. Other, <|endoftext|> it's é\u0301 \u0301x ΑΣ\n" * 40, "x" * 500 + " y\tz" * 99, " " * 300, "a\x1cb " * 60]
    for size in (1, 7, 100):
        monkeypatch.setattr(common, "PART_CHARS", size)
        monkeypatch.setattr(bpe, "PART_CHARS", size)
        monkeypatch.setattr(token_store, "PART_CHARS", size)
        assert all("".join(common.at_spaces(t)) == t for t in texts)
        same(library, texts)
        ids = [np.frombuffer(x, "<i4").tolist() for x in token_store.encoder(PATH)(texts)]
        assert ids == [w.ids for w in library.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=("Cn", "Cs"))))
def test_any_text(library, text):
    same(library, [text])


def test_rows(spark):
    rows = [(1, "Hello", 5), (1, "Hello", 5), (None, None, 6), (2, "", 7)]
    found = bpe_encode_decode(spark.createDataFrame(rows, "doc_id long, text string, ids long"), PATH).collect()
    assert sorted((r.doc_id or 0, list(r.ids), r.decoded) for r in found) == [(0, [], ""), (1, [3306], "hello</w>"), (1, [3306], "hello</w>"), (2, [], "")]


def test_no_rows(spark):
    assert bpe_encode_decode(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_remembered_chunks_are_bounded():
    known = bpe.Vocabulary(PATH)
    known._chunk = lambda chunk: b""
    for k in range(0, 700_000, 5000):
        known.encode(" ".join(f"w{i}" for i in range(k, k + 5000)))
    assert len(known.encoded.young) + len(known.encoded.old) < 450_000

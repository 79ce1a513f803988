from __future__ import annotations

import hashlib
import random
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from grantlens.llm import bpe
from tests.llm.helpers import clashing, docs, table


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_tokenizer())


@pytest.fixture(scope="module")
def codec():
    with open(bpe.default_tokenizer(), encoding="utf-8") as f:
        return bpe.Codec(f.read())


def packed(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return struct.pack(f"<{len(ids)}I", *ids)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_any_text_as_the_library(library, codec, text):
    ids = codec.encode(text)
    assert ids == packed(library, text)
    assert codec.decode(ids) == text


@pytest.mark.parametrize(
    "text",
    ["", "a<|endoftext|>b", "<|endoftext|><|endoftext|>", "x" * 5000, "  \n\n\t x", "\x1c\x1d\x85 a", "it's we'll 'S"]
)
def test_special_texts(library, codec, text):
    assert codec.encode(text) == packed(library, text)


def test_long_pieces_agree_with_short_ones(library, codec):
    rng = random.Random(1)
    for n in (39, 63, 66, 300, 3000):
        word = "".join(rng.choice("etaoinshrdlu") for _ in range(n))
        assert codec.encode(word) == packed(library, word)


def test_cuts_are_at_pairs_no_token_holds(codec):
    word = "zqxjkvwthhonh".encode()
    parts = codec.fragments(word)
    assert b"".join(parts) == word and len(parts) > 1
    assert all(a[-1:] + b[:1] not in t for a, b in zip(parts, parts[1:]) for t in codec.token.values() if len(t) < 40)


def test_kept_pieces_stay_bounded(codec, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 10)
    codec.encode(" ".join(f"w{i}" for i in range(50)))
    assert len(codec) <= 10 and len(codec.older) <= 300_000


def test_query_as_the_library(spark, library):
    got = {r.doc_id: r for r in bpe.op8_bpe(spark, "/root/testdata/sf0.001").collect()}
    want = table("documents")
    assert len(got) == len(want)
    for i, text in zip(want.doc_id, want.text):
        ids = packed(library, text)
        assert got[i].n_tokens == len(ids) // 4
        assert got[i].ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_nulls_empty_tables_and_extra_columns(spark):
    path = bpe.default_tokenizer()
    frame = clashing(docs(spark, None, "", "a b", "a b"))
    rows = bpe.digests(bpe.encode_decode(frame, path)).collect()
    assert [r.n_tokens for r in rows] == [0, 0, 2, 2]
    assert bpe.encode_decode(frame.limit(0), path).count() == 0

"""Encoding equals the library's, piece by piece and through Spark; decoding gives the bytes back."""

import base64
import hashlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from assayer.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks(PATH), public_tokenizers.PATTERN)


TEXTS = [
    "", " ", "  ", "\n", "a", " a", "a ", "a  b", "it's  they're\n\nI'll", "naïve 中文 👩‍👩‍👧  x y\x1cz\x85w",
    "=" * 3000, "a" * 3000, "ab" * 2000, "0123456789" * 300, " " * 2500 + "x", "é" * 1500, "word " * 3000,
    "averyveryverylongwordwithoutanyspaceinit" * 40, "don't.\nAnd\tso  on </s> <|endoftext|>",
]


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_equals_library(encoder, library, text):
    ids = list(encoder.encode_all([text]))[0]
    assert ids == library.encode_ordinary(text)
    assert encoder.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab=-' \n\tésS#中😀t​0"), max_size=200), st.integers(1, 6))
def test_any_text_equals_library(encoder, library, text, times):
    assert list(encoder.encode_all([text * times]))[0] == library.encode_ordinary(text * times)


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=120), st.binary(max_size=120))
def test_join_is_the_encoding_of_both(encoder, left, right):
    joined = encoder.join(encoder._merge_many(left) if left else [], encoder._merge_many(right) if right else [])
    assert joined == (encoder._merge_many(left + right) if left + right else [])


def test_merging_together_equals_merging_alone(encoder):
    pieces = [w.encode() for w in "tokenization of über-straße 😀😀 aaaaaaaaaaaaaaaaaaaaaaaa x".split()]
    assert encoder.merge_all(pieces) == [tuple(encoder.merge(p)) for p in pieces]


def test_digests_of_rows(spark, library):
    rows = [(1, "Hello  world", "x"), (1, "Hello  world", "x"), (2, None, None), (3, "", "y"), (None, "z" * 5000, "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")
    found = bpe.digests(docs, bpe.read_ranks(PATH), public_tokenizers.PATTERN).collect()
    expected = []
    for key, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        expected.append((key, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_encode_then_decode(spark):
    ranks = bpe.read_ranks(PATH)
    docs = spark.createDataFrame([(i, f"text {i} — ünï " * i) for i in range(20)], "doc_id bigint, text string")
    tokens = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    back = bpe.decode(tokens, ranks, public_tokenizers.PATTERN)
    assert {r.doc_id: bytes(r.data).decode() for r in back.collect()} == {r.doc_id: r.text for r in docs.collect()}
    assert bpe.encode(docs.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


def test_caches_are_bounded(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHED", 50)
    own = bpe.Encoder(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    texts = [" ".join(f"w{i * j}x{j}é" for j in range(300)) for i in range(5)] + ["=" * 900 + "a" * 400]
    for _ in range(2):
        assert list(own.encode_all(texts)) == [library.encode_ordinary(t) for t in texts]
        assert max(map(len, (own.cache, own.chunks, own.merged, own._stable))) <= 50


def test_parts_of_a_batch(monkeypatch):
    monkeypatch.setattr(bpe, "AT_ONCE", 10)
    texts = pa.array(["abc", None, "x" * 50, "", "y" * 10, "z"])
    assert list(bpe._parts(texts)) == [(0, 2), (2, 1), (3, 2), (5, 1)]
    assert list(bpe._parts(pa.array([[1], None, [1, 2], [], [1]], pa.list_(pa.int32())))) == [(0, 2), (2, 2), (4, 1)]


def test_texts_do_not_miss_what_they_have_filled_in(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHED", 50)
    own = bpe.Encoder(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    for batch in ("first", "second", "third"):
        words = [f"{batch}{chr(97 + i)}" for i in range(26)] + [f"{batch}{i}," for i in range(4)]
        texts = ["begin " + " ".join(words), "again " + " ".join(reversed(words))]
        own.learn(texts)
        assert own.chunks.keys() >= set(words) and len(own.chunks) <= 50
        assert list(own.encode_all(texts)) == [library.encode_ordinary(t) for t in texts]


def test_new_chunks_are_matched_in_one_go_and_kept_as_bytes(library):
    own = bpe.Encoder(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    calls, pieces = [], own.pieces
    own.pieces = lambda text: calls.append(text) or pieces(text)
    texts = ["begin " + " ".join(f"word{i}'s,x{i}" for i in range(j, j + 50)) for j in range(20)]
    own.learn(texts)
    assert len(calls) == 1
    assert own.chunks and all(type(ids) is bytes for cache in (own.chunks, own.cache) for ids in cache.values())
    assert list(own.encode_all(texts)) == [library.encode_ordinary(t) for t in texts]


def test_a_pattern_that_leaves_characters_out():
    own = bpe.Encoder(bpe.read_ranks(PATH), r" ?[a-z]+")
    text = "one two3 4four 5 six"
    assert own.decode(list(own.encode_all([text]))[0]) == b"one twofour six"

"""Alignment equals a plain walk over the tokens that the public libraries give."""

import hashlib
import json
import os
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet
import pytest
import sentencepiece
from tokenizers import Tokenizer

from assayer.llm import alignment
from assayer.llm.queries import QUERIES

FILES = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


@pytest.fixture(scope="module")
def contents():
    return [open(f, "rb").read() for f in FILES]


@pytest.fixture(scope="module")
def libraries():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    first = Tokenizer.from_file(FILES[0])
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=FILES[1])


def walk(text, libraries):
    """(A ids, B ids, groups, links), from the tokens' bytes alone."""
    first, second = libraries
    nothing = [], [], [], []
    if not text:
        return nothing
    a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
    alphabet = alignment.byte_alphabet()
    spelled_a = [bytes(alphabet[c] for c in first.id_to_token(i)) for i in a]
    spelled_b = []
    for i in b:
        piece = second.id_to_piece(i)
        spelled_b.append(bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode())
    if not b"".join(spelled_a) == b"".join(spelled_b) == (" " + text).encode():
        return nothing
    groups, links, i, j, size_a, size_b, of_a, of_b = [], [], 0, 0, 0, 0, [], []
    while i < len(a) or j < len(b):
        if size_a <= size_b and i < len(a) or j == len(b):
            size_a += len(spelled_a[i])
            of_a.append(a[i])
            i += 1
        else:
            size_b += len(spelled_b[j])
            of_b.append(b[j])
            j += 1
        if size_a == size_b:
            groups.append((of_a, of_b))
            links.append((of_a[-1], of_b[-1]))
            of_a, of_b = [], []
    return a, b, groups, links


def brute(rows, libraries):
    walked = [(key, *walk(text, libraries)) for key, text in rows]
    counts = Counter(pair for *_, links in walked for pair in links)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for key, a, b, groups, links in walked:
        listed = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        sha = hashlib.sha256(listed.encode()).hexdigest() if groups else ""
        best = sum(counts[p] == most[p[1]] for p in links)
        out.append((key, len(a), len(b), len(groups), len(links), best, sum(counts[p] for p in links), sha))
    return sorted(out, key=lambda t: tuple((v is None, str(v)) for v in t))


TEXTS = [
    None, "", " ", "a", " a", "a b", "  b  c\n\n", "naïve 中文 👩‍👩‍👧  x y\x1cz\x85w", "<unk> </s> <s> <0x41> <|endoftext|>", "▁a ▁", "a\x00b",
    "word " * 3000, "=" * 5000, "a" * 20_000, " " * 5000, "don't stop\t\tnow\r\n", "﻿x", "é", "½ ﬁ", "the the the cat", "the cat", "the cat",
]


@pytest.mark.parametrize("head", [alignment.HEAD, 300, 1, 0])
def test_equals_walk(spark, rows, contents, libraries, head):
    data = [(i, text) for i, text in enumerate(TEXTS)] + [(3, "a"), (3, "a"), (None, "the cat"), (7, None)]
    docs = spark.createDataFrame([(text, 1, key, "x", 2) for key, text in data], "text string, row int, doc_id bigint, a string, n int").repartition(3)
    found = alignment.align(docs, *contents, public_tokenizers.PATTERN, head=head)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows(found) == brute(data, libraries)


def test_documents_equal_walk(spark, rows, libraries):
    folder = "/root/testdata/sf0.001"
    table = pyarrow.parquet.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"])
    data = list(zip(*(table[c].to_pylist() for c in ("doc_id", "text"))))
    assert rows(QUERIES["op12_token_alignment"](spark, folder)) == brute(data, libraries)


def test_parts_of_a_batch(monkeypatch):
    monkeypatch.setattr(alignment, "AT_ONCE", 10)
    assert list(alignment._parts(pa.array([3, None, 50, 0, 10, 1]))) == [(0, 2), (2, 1), (3, 2), (5, 1)]


def test_no_documents_and_no_tokens(spark, contents):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert alignment.align(empty, *contents, public_tokenizers.PATTERN).collect() == []
    none = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert {tuple(r)[1:] for r in alignment.align(none, *contents, public_tokenizers.PATTERN).collect()} == {(0, 0, 0, 0, 0, 0, "")}


def test_head_is_bounded(spark):
    pairs = spark.createDataFrame([(i, 0, 2 ** (i % 5), True) for i in range(50)], "a int, b int, n bigint, best boolean")
    assert [alignment.least_of_head(pairs, h) for h in (50, 49, 20, 9, 0)] == [1, 2, 8, 32, 32]


def test_refuses_ids_out_of_order(contents):
    model = json.loads(contents[0])
    vocab = model["model"]["vocab"]
    vocab["Ġt"], vocab["Ġa"] = vocab["Ġa"], vocab["Ġt"]
    with pytest.raises(ValueError, match="order"):
        alignment.ByteLevel(json.dumps(model).encode(), public_tokenizers.PATTERN)

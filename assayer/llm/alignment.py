"""Alignment of two tokenizers over the same text, on Arrow tables.

A task encodes its documents with both tokenizers and flattens the two lists of ids, with the document each id belongs to.
Running sums of the tokens' bytes, begun anew at each document, are the offsets at which tokens end; a hash join on
(document, end) finds where tokens of both end together. These places cut a document into groups, and the two tokens that
end there are linked.

How often an id pair is linked in the corpus is counted by `Table.group_by` in each task; Spark adds the partial
counts. The documents' links are then looked up in these counts: the frequent pairs, at most `HEAD` of them whatever the corpus,
are held by every task, and links of all other pairs are joined by Spark. So no pair is hot in a shuffle, and what
is broadcast does not grow.

The first encoding is byte-level BPE from a `tokenizer.json`, run by a library that merges by rank; it is refused if
its ids are not in the order of its merges. The second is a SentencePiece model with byte fallback.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.scratch import new_path, written

HEAD = 2**20  # pairs that every task holds: 17 bytes each
AT_ONCE = 500_000  # characters encoded, and links looked up, together
BLOCK = 2**24  # bytes of links that a task holds before it writes them
COUNTED = 500_000  # pairs that a task counts before it hands them on


# Tokenizers


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself where it is printable, else one of those from 256."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Byte-level BPE of a `tokenizer.json`; special tokens are plain text."""

    def __init__(self, content: bytes, pattern: str):
        model = json.loads(content)
        alphabet, special = byte_alphabet(), {t["content"] for t in model["added_tokens"]}
        decoded = lambda token: bytes(map(alphabet.__getitem__, token))
        ranks = {decoded(token): i for token, i in model["model"]["vocab"].items() if token not in special}
        joined = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
        if [ranks[decoded(a + b)] for a, b in joined] != list(range(256, len(ranks))):
            raise ValueError("the ids are not in the order of the merges")
        splitter = model["pre_tokenizer"]
        if model["normalizer"] or splitter["type"] != "ByteLevel" or splitter["add_prefix_space"] or not splitter["use_regex"]:
            raise ValueError("not plain byte-level BPE")
        self._core = tiktoken.Encoding("alignment", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.tokens = pa.array([t for t, _ in sorted(ranks.items(), key=lambda r: r[1])], pa.binary())

    def encode(self, texts: list[str]) -> pa.ListArray:
        ids = [np.frombuffer(self._core.encode_to_tiktoken_buffer(text, set()), np.uint32) for text in texts]
        return _lists(ids)


class Pieces:
    """A SentencePiece model; it adds the first space by itself."""

    def __init__(self, content: bytes):
        self._model = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.tokens = pa.array([self._bytes(i) for i in range(self._model.get_piece_size())], pa.binary())

    def _bytes(self, i: int) -> bytes:
        piece = self._model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self._model.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> pa.ListArray:
        return _lists([np.array(ids, np.int32) for ids in self._model.encode(texts, num_threads=1)])


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate([*ids, np.empty(0, np.int32)]).astype(np.int32))


@lru_cache(maxsize=2)
def _tokenizers(first: bytes, second: bytes, pattern: str) -> tuple[ByteLevel, Pieces]:
    both = ByteLevel(first, pattern), Pieces(second)
    if any(pc.any(pc.equal(pc.binary_length(t.tokens), 0)).as_py() for t in both):
        raise ValueError("a vocabulary holds an empty token")
    return both


# Aligning


def ends(lists: pa.ListArray, tokens: pa.BinaryArray) -> pa.Table:
    """(end, at) of each token: its list and the offset in it at which its bytes end, as one number, and its place among all."""
    ids, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
    sizes = pc.cast(pc.binary_length(tokens), pa.int64()).take(ids)
    running = pc.cumulative_sum(sizes)
    filled = pc.greater(pc.list_value_length(lists), 0)
    begun = pc.subtract(running, sizes).take(lists.offsets[:-1].filter(filled))
    first = np.zeros(len(lists), np.int64)
    first[filled.to_numpy(zero_copy_only=False)] = begun
    offsets = pc.subtract(running, pa.array(first).take(doc))
    return pa.table({"end": pc.add(pc.shift_left(pc.cast(doc, pa.int64()), 40), offsets), "at": pa.array(np.arange(len(ids), dtype=np.int32))})


def _same_bytes(lists: pa.ListArray, tokens: pa.BinaryArray, data: list[bytes]) -> np.ndarray:
    """Whether the bytes of each list of tokens are those given."""
    joined = pc.binary_join(pa.ListArray.from_arrays(lists.offsets, tokens.take(pc.list_flatten(lists))), b"")
    return pc.equal(joined, pa.array(data, pa.binary())).to_numpy(zero_copy_only=False)


def _cut(ids: pa.Array, places: np.ndarray) -> pa.Array:
    """The ids as text, those between two places joined by commas."""
    offsets = np.concatenate([[0], places + 1]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(offsets, pc.cast(ids, pa.string())), ",")


def packed(ids: np.ndarray, offsets: np.ndarray) -> pa.BinaryArray:
    """Lists of ids, each as bytes; Spark copies these whole, an array element by element."""
    places = (offsets * ids.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(ids)])


def unpacked(lists: pa.BinaryArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all lists, one after the other, and how many each has."""
    ids = np.frombuffer(b"".join(x.as_buffer() for x in lists), kind)
    return ids, pc.binary_length(lists).to_numpy(zero_copy_only=False) // np.dtype(kind).itemsize


def id_kind(*tokens: pa.Array) -> str:
    """The type of packed ids: two bytes if all of them fit."""
    return "<u2" if max(map(len, tokens)) <= 2**16 else "<u4"


def aligned(texts: list[str | None], first: ByteLevel, second: Pieces) -> pa.Table:
    """(n_a, n_b, n_groups, n_links, groups_sha256, a, b) of each text; `a` and `b` are the packed ids of its links, in order."""
    data = [(" " + (text or "")).encode() for text in texts]
    a = first.encode([" " + text if text else "" for text in texts])
    b = second.encode([text or "" for text in texts])
    fit = _same_bytes(a, first.tokens, data) & _same_bytes(b, second.tokens, data)
    none = pa.scalar([], pa.list_(pa.int32()))
    if not fit.all():  # the texts without tokens get empty lists
        a, b = (pc.if_else(pa.array(fit), x, none) for x in (a, b))
        a, b = (pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(pc.list_value_length(x))]).astype(np.int32), pc.list_flatten(x)) for x in (a, b))
    ids_a, ids_b = pc.list_flatten(a), pc.list_flatten(b)
    left, right = ends(a, first.tokens), ends(b, second.tokens)
    links = left.join(right, keys="end", join_type="inner", right_suffix="_b", use_threads=False).sort_by("at").combine_chunks()
    at = {"a": links["at"].combine_chunks(), "b": links["at_b"].combine_chunks()}
    groups = pc.binary_join_element_wise(_cut(ids_a, at["a"].to_numpy()), _cut(ids_b, at["b"].to_numpy()), "|")
    counts = np.bincount(links["end"].to_numpy() >> 40, minlength=len(texts)).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    listed = pc.binary_join(pa.ListArray.from_arrays(offsets, groups), ";")
    shas = [hashlib.sha256(x.as_buffer()).hexdigest() if n else "" for x, n in zip(listed, counts)]
    kind = id_kind(first.tokens, second.tokens)
    linked = {c: packed(ids.take(at[c]).to_numpy().astype(kind), offsets) for c, ids in (("a", ids_a), ("b", ids_b))}
    sizes = {n: pc.cast(pc.list_value_length(x), pa.int64()) for n, x in (("n_a", a), ("n_b", b))}
    return pa.table({**sizes, "n_groups": counts, "n_links": counts, "groups_sha256": shas, **linked})


def _parts(sizes: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, length) of parts of a batch whose sizes add up to `AT_ONCE` at most, or of one row."""
    total, start = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False)), 0
    while start < len(total):
        stop = int(np.searchsorted(total, (total[start - 1] if start else 0) + AT_ONCE, "right"))
        stop = max(start + 1, stop)
        yield start, stop - start
        start = stop


def link(docs: DataFrame, first: bytes, second: bytes, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, key, n_a, n_b, n_groups, n_links, groups_sha256, a, b) of each document, written; `row` tells rows apart."""
    shared = docs.sparkSession.sparkContext.broadcast((first, second, pattern))  # the size of the vocabularies
    counts = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint"
    schema = f"row bigint, `{key}` {dict(docs.dtypes)[key]}, {counts}, groups_sha256 string, a binary, b binary"

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _tokenizers(*shared.value)
        for batch in stream:
            for start, n in _parts(pc.utf8_length(batch.column("text"))):
                part = batch.slice(start, n)
                table = aligned(part.column("text").to_pylist(), *both)
                for i, name in enumerate(("row", key)):
                    table = table.add_column(i, name, part.column(name))
                yield from table.to_batches()

    rows = docs.select(F.monotonically_increasing_id().alias("row"), key, F.col(text).alias("text"))
    path = new_path(docs.sparkSession, "links")
    rows.mapInArrow(batches, schema).write.option("parquet.block.size", BLOCK).parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def _counted(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["a", "b", "n"])


def pair_counts(links: DataFrame, kind: str) -> DataFrame:
    """(a, b, n, best): how many links hold each id pair, and whether no pair of its `b` has more, written."""

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in stream:
            for start, n in _parts(pc.binary_length(batch.column("a"))):
                ids = {c: unpacked(batch.column(c).slice(start, n), kind)[0].astype(np.int32) for c in ("a", "b")}
                held = [_counted([*held, pa.table({**ids, "n": np.ones(len(ids["a"]), np.int64)})])]
                if held[0].num_rows > COUNTED:
                    yield from held.pop().to_batches()
        if held:
            yield from held[0].to_batches()

    partial = links.select("a", "b").mapInArrow(batches, "a int, b int, n bigint")
    pairs = written(partial.groupBy("a", "b").agg(F.sum("n").alias("n")), "pairs")
    most = pairs.groupBy("b").agg(F.max("n").alias("most"))  # a row for each id of the second vocabulary
    return written(pairs.join(F.broadcast(most), "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def least_of_head(pairs: DataFrame, head: int = HEAD) -> int:
    """The smallest power of two such that at most `head` pairs are linked as often."""
    power = F.floor(F.log2("n") + 1e-9).cast("int")
    sizes = {row.p: row["count"] for row in pairs.groupBy(power.alias("p")).count().collect()}  # 64 rows
    least, held = max(sizes, default=0) + 1, 0
    while least > 0 and held + sizes.get(least - 1, 0) <= head:
        least -= 1
        held += sizes.get(least, 0)
    return 2**least


def score(links: DataFrame, pairs: DataFrame, kind: str, head: int = HEAD) -> DataFrame:
    """The columns of `links` but `a` and `b`, with `n_best` and `count_sum` over the links of each row."""
    least = least_of_head(pairs, head)
    code = F.shiftleft(F.col("a").cast("bigint"), 32) + F.col("b")
    frequent = pairs.where(F.col("n") >= least).select(code.alias("code"), "n", "best").toArrow()  # `head` rows
    table = tuple(frequent[c].to_numpy() for c in ("code", "n", "best"))
    shared = links.sparkSession.sparkContext.broadcast(table)
    kept = [c for c in links.columns if c not in ("a", "b")]
    kinds = dict(links.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in kept] + ["n_best bigint, count_sum bigint, a array<int>, b array<int>"])

    def looked_up(batch: pa.RecordBatch, codes: pa.Array, numbers: np.ndarray, bests: np.ndarray) -> pa.RecordBatch:
        (a, sizes), (b, _) = (unpacked(batch.column(c), kind) for c in ("a", "b"))
        at = pc.index_in(pa.array((a.astype(np.int64) << 32) + b), value_set=codes)
        hit = at.is_valid().to_numpy(zero_copy_only=False)
        at = pc.fill_null(at, 0).to_numpy()
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[offsets])
        rest = np.concatenate([[0], np.cumsum(total(~hit))]).astype(np.int32)
        added = [pa.array(total(np.where(hit, x[at], 0))) for x in (bests, numbers)]
        added += [pa.ListArray.from_arrays(rest, pa.array(x[~hit].astype(np.int32))) for x in (a, b)]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *added], [*kept, "n_best", "count_sum", "a", "b"])

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, *values = shared.value
        values = [np.append(x, 0).astype(np.int64) for x in values]
        for batch in stream:
            for start, n in _parts(pc.binary_length(batch.column("a"))):
                yield looked_up(batch.slice(start, n), pa.array(codes), *values)

    scored = links.mapInArrow(batches, schema)
    if least == 1:  # every pair is among the frequent ones
        return scored.drop("a", "b")
    scored = written(scored, "scored")
    zipped = F.explode(F.arrays_zip("a", "b"))
    rare = scored.select("row", zipped.alias("z")).select("row", "z.a", "z.b").groupBy("row", "a", "b").agg(F.count("*").alias("k"))
    found = rare.join(pairs.where(F.col("n") < least), ["a", "b"])
    more = found.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("_best"), F.sum(F.col("k") * F.col("n")).alias("_sum"))
    both = scored.drop("a", "b").join(more, "row", "left")
    plus = {"n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0))}
    return both.withColumns(plus).drop("_best", "_sum")


def align(docs: DataFrame, first: bytes, second: bytes, pattern: str, key: str = "doc_id", text: str = "text", head: int = HEAD) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row.

    A text that is NULL, empty, or whose tokens of either kind do not spell a space and the text has no tokens: zeros and ''.
    Rows stay as they are, repeated ones and NULL keys included; pairs tied for the most of their `b` are all best; an
    empty table gives an empty table; columns other than key and text are not read. A text is in memory whole, with its
    tokens; groups of one text may take up to 2 GB as text, about 400 MB of prose.
    """
    links = link(docs, first, second, pattern, key, text)
    kind = id_kind(*(t.tokens for t in _tokenizers(first, second, pattern)))
    scored = score(links, pair_counts(links, kind), kind, head)
    return scored.select(key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

"""Byte-level BPE by tree reduction.

Encodings of byte strings form a monoid: the encoding of `ab` follows from those of `a` and `b`.
A long piece is halved until its parts are short, the parts are merged by rank, and neighbours are
joined by encoding a window around their border anew. A sequence of tokens is the encoding of its
bytes if and only if every two neighbours are the encoding of their own bytes, so the window may
stop growing as soon as its first and last token stand this test with the token outside: no pair
outside the window has changed. Decoding concatenates up the same tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

LEAF = 32  # bytes that are merged at once
WIDTHS = (8, 16, LEAF)  # bytes of the tables in which many pieces are merged together
NONE = np.iinfo(np.int32).max  # the rank of a pair that is not merged
ROWS = 8_192  # rows of such a table, which bounds its memory
CACHED = 150_000  # entries of each cache of a Python worker, ids as bytes; a full cache is emptied
AT_ONCE = 1_000_000  # bytes of texts or ids whose results are made together, or one row
CACHED_BYTES = 64  # longer texts are not kept


def read_ranks(path: str) -> bytes:
    """The lines of a rank file, `base64 rank`, as they are; small enough to be sent to the tasks."""
    with open(path, "rb") as file:
        return file.read()


class Encoder:
    def __init__(self, ranks: bytes, pattern: str):
        self.ids = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines()) if token}
        self.bytes_of = {rank: token for token, rank in self.ids.items()}
        if max(self.ids.values(), default=0) > len(self.ids):
            raise ValueError("ranks must be numbered without gaps")
        self.pieces = regex.compile(pattern).findall
        self.merged: dict[bytes, list[int]] = {}
        self.cache = _Cache(self)
        self.chunks = _Chunks(self)
        self._stable: dict[tuple[int, int], bool] = {}
        pairs = sorted(
            (self.ids[token[:i]] * len(self.ids) + self.ids[token[i:]], rank)
            for token, rank in self.ids.items()
            for i in range(1, len(token))
            if token[:i] in self.ids and token[i:] in self.ids
        )
        self._pair_keys, self._pair_ranks = np.array(pairs, np.int64).reshape(-1, 2).T.copy()
        self._byte_ids = np.array([self.ids[bytes([i])] for i in range(256)], np.int32)
        self._byte_ranks = self._ranks(np.repeat(self._byte_ids, 256), np.tile(self._byte_ids, 256))  # of two bytes

    def learn(self, texts: list[str]) -> None:
        """Fills the caches with what occurs in many texts, merging all new pieces together."""
        for cache in (self.cache, self.chunks, self.merged, self._stable):
            _room(cache)
        seen: set[str] = set()
        for text in texts:
            seen.update(text.split(" ")[1:])
        new = seen.difference(self.chunks.keys())
        if len(self.chunks) + len(new) > CACHED:  # emptied before the texts and not among them, or they would miss what they have filled in
            self.chunks.clear()
            new = seen
        if len(self.cache) + len(new) > CACHED:
            self.cache.clear()
        chunks = [c for c in new if c and len(c) <= CACHED_BYTES and c.strip() == c]
        joined = " ".join(["", *chunks])
        parts = self.pieces(joined)  # in one go, as a single space always begins a match
        if sum(map(len, parts)) != len(joined):  # the pattern leaves characters out: lengths do not tell where a chunk ends
            chunks, parts = [], []
        pieces = [p for p in set(parts) if p not in self.cache]
        fresh = dict(zip(pieces, self._packed_all([p.encode() for p in pieces])))
        at = 0
        for chunk in chunks:
            if len(self.chunks) >= CACHED:
                _room(self.chunks)
            first, left = parts[at], len(chunk) + 1
            at += 1
            if len(first) == left and first in fresh:
                self.chunks[chunk] = fresh[first]  # the chunk stands for its only piece, which is not kept twice
                continue
            some, left = [first], left - len(first)
            while left:
                some.append(parts[at])
                left -= len(parts[at])
                at += 1
            for part in some:
                if part in fresh and part not in self.cache:
                    _room(self.cache)
                    self.cache[part] = fresh[part]
            self.chunks[chunk] = b"".join([fresh[p] if p in fresh else self.cache[p] for p in some])

    def encode(self, text: str) -> list[int]:
        """The ids of a text: each match of the pattern by itself."""
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def packed(self, text: str) -> bytes:
        """The ids of a text, four bytes each.

        A single space between two other characters always begins a match, so the chunks that
        stand between such spaces are encoded by themselves and looked up in a cache.
        """
        head, *chunks = text.split(" ")
        if not head or head[-1].isspace():
            return self.encode_chunk(text)
        try:
            return b"".join([self.encode_chunk(head), *map(self.chunks.__getitem__, chunks)])
        except _Spaced:
            return self.encode_chunk(text)

    def packed_all(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text, four bytes each; NULL counts as an empty one."""
        texts = [text or "" for text in texts]
        self.learn(texts)
        return map(self.packed, texts)

    def encode_all(self, texts: list[str | None]) -> Iterator[list[int]]:
        return (np.frombuffer(ids, np.int32).tolist() for ids in self.packed_all(texts))

    def encode_chunk(self, text: str) -> bytes:
        return b"".join(map(self.cache.__getitem__, self.pieces(text)))

    def encode_piece(self, piece: bytes) -> list[int]:
        """Encodes the halves and joins them, without recursion deeper than the tree."""
        if len(piece) <= LEAF:
            return self.merge(piece)
        middle = len(piece) // 2
        return self.join(self.encode_piece(piece[:middle]), self.encode_piece(piece[middle:]))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of two encodings, one after the other."""
        if not left or not right:
            return left or right
        reach = 1
        while True:
            start, stop = max(0, len(left) - reach), min(len(right), reach)
            window = self.merge(self.decode(left[start:] + right[:stop]))
            before = start == 0 or self.stable(left[start - 1], window[0])
            after = stop == len(right) or self.stable(window[-1], right[stop])
            if before and after:
                return left[:start] + window + right[stop:]
            reach *= 2

    def stable(self, first: int, second: int) -> bool:
        """Whether two tokens are the encoding of their bytes."""
        pair = first, second
        found = self._stable.get(pair)
        if found is None:
            _room(self._stable)
            found = self._stable[pair] = self.merge(self.bytes_of[first] + self.bytes_of[second]) == [first, second]
        return found

    def merge(self, piece: bytes) -> list[int]:
        """Merges the neighbours of lowest rank, leftmost first, until none can be merged."""
        whole = self.ids.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) > LEAF:
            return self._merge_many(piece)
        found = self.merged.get(piece)
        if found is None:
            _room(self.merged)
            found = self.merged[piece] = self._merge_few(piece)
        return found

    def merge_all(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """`merge` of many pieces."""
        return [tuple(np.frombuffer(ids, np.int32).tolist()) for ids in self._packed_all(pieces)]

    def _packed_all(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of many pieces; short ones are merged together: a step merges one pair in each row of a table."""
        out = [b""] * len(pieces)
        groups: dict[int, list[int]] = {width: [] for width in WIDTHS}
        width_of = [next((w for w in WIDTHS if n <= w), 0) for n in range(LEAF + 1)]
        for i, piece in enumerate(pieces):
            whole = self.ids.get(piece)
            if whole is not None:
                out[i] = _pack([whole])
            elif len(piece) > LEAF:
                out[i] = _pack(self.encode_piece(piece))
            else:
                groups[width_of[len(piece)]].append(i)
        for width, group in groups.items():
            for at in range(0, len(group), ROWS):
                rows = group[at : at + ROWS]
                self._merge_table(np.array(rows), [pieces[i] for i in rows], width, out)
        return out

    def _merge_table(self, rows: np.ndarray, pieces: list[bytes], width: int, out: list[bytes]) -> None:
        data = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in pieces]), np.uint8).reshape(-1, width)
        columns, lengths = np.arange(width), np.fromiter(map(len, pieces), np.int64, len(pieces))[:, None]
        ids = np.where(columns < lengths, self._byte_ids[data], np.int32(-1))
        ranks = np.where(columns[1:] < lengths, self._byte_ranks[data[:, :-1].astype(np.int32) * 256 + data[:, 1:]], np.int32(NONE))
        while len(rows):
            best = ranks.argmin(1)
            token = ranks[np.arange(len(rows)), best]
            done = token == NONE
            if done.any():
                ended = ids[done]
                stops, data = np.cumsum((ended >= 0).sum(1)) * 4, ended[ended >= 0].tobytes()
                start = 0
                for i, stop in zip(rows[done].tolist(), stops.tolist()):
                    out[i] = data[start:stop]
                    start = stop
                rows, ids, ranks, best, token = (x[~done] for x in (rows, ids, ranks, best, token))
            every, behind = np.arange(len(rows)), columns > best[:, None]
            ids = np.where(behind, np.pad(ids[:, 1:], ((0, 0), (0, 1)), constant_values=-1), ids)
            ids[every, best] = token
            ranks = np.where(behind[:, :-1], np.pad(ranks[:, 1:], ((0, 0), (0, 1)), constant_values=NONE), ranks)
            ranks[every, best] = self._ranks(token, ids[every, best + 1])
            inner = every[best > 0]
            at = best[inner]
            ranks[inner, at - 1] = self._ranks(ids[inner, at - 1], token[inner])

    def _ranks(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        keys = first.astype(np.int64) * len(self.ids) + second
        at = np.minimum(np.searchsorted(self._pair_keys, keys), len(self._pair_keys) - 1)
        hit = (self._pair_keys[at] == keys) & (first >= 0) & (second >= 0)
        return np.where(hit, self._pair_ranks[at], NONE).astype(np.int32)

    def _merge_few(self, piece: bytes) -> list[int]:
        rank_of, none = self.ids.get, NONE
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = [rank_of(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            token = parts[at] = parts[at] + parts.pop(at + 1)
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank_of(token + parts[at + 1], none)
            if at:
                ranks[at - 1] = rank_of(parts[at - 1] + token, none)
        return [self.ids[part] for part in parts]

    def _merge_many(self, piece: bytes) -> list[int]:
        """The same with a queue of pairs, for long windows."""
        n = len(piece)
        stop = list(range(1, n + 1))  # where the part that begins here ends; 0 for no part
        previous = list(range(-1, n - 1))
        queue: list[tuple[int, int, int]] = []

        def offer(start: int) -> None:
            middle = stop[start]
            if middle < n:
                rank = self.ids.get(piece[start : stop[middle]])
                if rank is not None:
                    heapq.heappush(queue, (rank, start, stop[middle]))

        for start in range(n - 1):
            offer(start)
        while queue:
            _, start, end = heapq.heappop(queue)
            middle = stop[start]
            if middle == 0 or middle >= n or stop[middle] != end:
                continue  # one of the two has been merged with another meanwhile
            stop[start], stop[middle] = end, 0
            if end < n:
                previous[end] = start
            offer(start)
            if start:
                offer(previous[start])
        out, at = [], 0
        while at < n:
            out.append(self.ids[piece[at : stop[at]]])
            at = stop[at]
        return out

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= 4096:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


def _pack(ids: list[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()


def _room(cache: dict) -> None:
    if len(cache) >= CACHED:
        cache.clear()


class _Cache(dict):
    """Matches of the pattern and their ids, filled as they occur."""

    def __init__(self, encoder: Encoder):
        self._encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode()
        ids = _pack(self._encoder.encode_piece(data))
        if len(data) <= CACHED_BYTES:
            _room(self)
            self[piece] = ids
        return ids


class _Spaced(Exception):
    """A chunk does not stand between two single spaces."""


class _Chunks(dict):
    """What stands between two single spaces, and the ids of the first space and the chunk."""

    def __init__(self, encoder: Encoder):
        self._encoder = encoder

    def __missing__(self, chunk: str) -> bytes:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _Spaced
        ids = self._encoder.encode_chunk(" " + chunk)
        if len(chunk) <= CACHED_BYTES:
            _room(self)
            self[chunk] = ids
        return ids


@lru_cache(maxsize=2)
def _encoder(ranks: bytes, pattern: str) -> Encoder:
    return Encoder(ranks, pattern)


def _parts(values: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, length) of parts of a column with `AT_ONCE` bytes at most, or of one row."""
    if pa.types.is_list(values.type):
        sizes = pc.multiply(pc.cast(pc.list_value_length(values), pa.int64()), 4)
    else:
        sizes = pc.cast(pc.binary_length(values), pa.int64())
    total, start = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False)), 0
    while start < len(total):
        stop = int(np.searchsorted(total, (total[start - 1] if start else 0) + AT_ONCE, "right"))
        stop = max(start + 1, stop)
        yield start, stop - start
        start = stop


def _per_row(
    df: DataFrame, column: str, schema: str, make: Callable[[], Callable], arrow: list[tuple[str, pa.DataType]], keep: list[str]
) -> DataFrame:
    """Adds columns computed in Python from the values of `column` in a part of an Arrow batch."""
    kept = [f"`{c}` {t}" for c, t in df.select(*keep).dtypes]

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in stream:
            for start, n in _parts(batch.column(column)):  # bounds the memory that results take
                part = batch.slice(start, n)
                rows = compute(part.column(column).to_pylist())
                values = zip(*rows)
                added = [pa.array(v, kind) for v, (_, kind) in zip(values, arrow)]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + added, [*keep, *(n for n, _ in arrow)])

    return df.select(*dict.fromkeys([*keep, column])).mapInArrow(batches, ", ".join([*kept, schema]))


def encode(docs: DataFrame, ranks: bytes, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keep.., ids, n_tokens): the ids of each whole text; NULL counts as an empty text.

    An empty text has no ids. Rows stay as they are, repeated ones included; an empty table gives
    an empty table; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # the size of the rank file

    def make():
        encoder = _encoder(shared.value, pattern)

        def compute(texts: list[str | None]):
            return [(np.frombuffer(ids, np.int32), len(ids) // 4) for ids in encoder.packed_all(texts)]

        return compute

    arrow = [("ids", pa.list_(pa.int32())), ("n_tokens", pa.int64())]
    return _per_row(docs, text, "ids array<int>, n_tokens bigint", make, arrow, list(keep))


def decode(tokens: DataFrame, ranks: bytes, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keep.., data): the bytes of a column `ids`; NULL counts as no ids."""
    shared = tokens.sparkSession.sparkContext.broadcast(ranks)

    def make():
        encoder = _encoder(shared.value, pattern)
        return lambda values: [(encoder.decode(ids or []),) for ids in values]

    return _per_row(tokens, "ids", "data binary", make, [("data", pa.binary())], list(keep))


def digests(
    docs: DataFrame, ranks: bytes, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False
) -> DataFrame:
    """(keep.., n_tokens, ids_sha256, decoded_sha256[, ids]): what `encode` and then `decode` give, hashed in
    the same task, so that bytes do not leave it, nor ids unless they are asked for. NULL counts as an empty text."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def make():
        encoder = _encoder(shared.value, pattern)

        def digest(packed: bytes):
            ids = np.frombuffer(packed, np.int32)
            stored = packed if sys.byteorder == "little" else ids.astype("<u4").tobytes()
            found = len(ids), hashlib.sha256(stored).hexdigest(), hashlib.sha256(encoder.decode(ids.tolist())).hexdigest()
            return (*found, ids) if with_ids else found

        def compute(texts: list[str | None]):
            return map(digest, encoder.packed_all(texts))

        return compute

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    arrow = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    if with_ids:
        schema, arrow = schema + ", ids array<int>", [*arrow, ("ids", pa.list_(pa.int32()))]
    return _per_row(docs, text, schema, make, arrow, list(keep))

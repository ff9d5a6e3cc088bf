"""Near-duplicate documents by MinHash bands and odd sketches.

A document is its set of word shingles. MinHash samples of a set are cut into bands; documents that agree
in a band are candidates. The samples are also folded into a bitmap in which each flips one bit (an odd sketch):
the bits in which two bitmaps differ tell how many samples differ, and so the similarity, without the sets.
Candidates that the sketches let pass are confirmed on the full sets.

Equal sets are one node from the start. In a band the smallest document and a random one are compared with all others, which joins
nearly all of a group with a few comparisons for each member. Only members of a band that are still in different
components are compared with each other after that, so a group of near copies never becomes all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import SIMILARITY, WORD_SIZE, perhaps_in
from assayer.llm.components import components, joined_components
from assayer.scratch import written

# At a similarity of 0.8 two sets agree in none of the bands in 1 of 8 million cases.
BANDS, ROWS = 40, 5
SAMPLES = BANDS * ROWS
SKETCH_BITS = 1024
# The sketch's estimate is off by about 0.029 (one standard deviation) at 0.8; five of them are allowed for.
SLACK = 0.145

_random = np.random.default_rng(20_240_131)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64)
_STEP, _MIX, _LENGTH = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_ADD = _random.integers(1, 2**63, SAMPLES, dtype=np.uint64)[:, None]
_TIMES = _random.integers(1, 2**63, SAMPLES, dtype=np.uint64)[:, None] | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * _LENGTH
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word, A-Z in lower case."""
    data = np.frombuffer(text.encode().lower(), np.uint8)  # bytes.lower changes A-Z only
    inside = np.flatnonzero(~_SPACE[data])
    if not len(inside):
        return np.empty(0, np.uint64)
    first = np.flatnonzero(np.diff(inside, prepend=-2) > 1)
    sizes = np.diff(first, append=len(inside))
    place = np.arange(len(inside)) - np.repeat(first, sizes)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(sizes.max()), _STEP))
        sums = np.add.reduceat(_BYTE[data[inside]] * powers[place], first)
        return _mixed(sums + sizes.astype(np.uint64) * _LENGTH)


def shingles(text: str | None, words: int) -> np.ndarray:
    """The set of hashes of `words` words in a row, sorted; of all words if there are fewer."""
    hashes = word_hashes(text or "")
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    with np.errstate(over="ignore"):
        rows = len(hashes) - width + 1
        out = np.full(rows, np.uint64(width))
        for i in range(width):
            out = _mixed(out * _STEP + hashes[i : i + rows])
    return np.unique(out)


def min_hashes(found: np.ndarray) -> np.ndarray:
    least = np.full((SAMPLES, 1), np.iinfo(np.uint64).max)
    with np.errstate(over="ignore"):
        for start in range(0, len(found), 2048):  # bounds the table for a long document
            part = (found[start : start + 2048] ^ _ADD) * _TIMES
            least = np.minimum(least, part.min(axis=1, keepdims=True))
    return least[:, 0]


def bands_of(samples: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.arange(BANDS, dtype=np.uint64)
        for i in range(ROWS):
            out = _mixed(out * _STEP + samples.reshape(BANDS, ROWS)[:, i])
    return out.view(np.int64)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """A bitmap in 64-bit words: every sample flips the bit that its number and value hash to."""
    with np.errstate(over="ignore"):
        spots = _mixed(samples * _STEP + np.arange(SAMPLES, dtype=np.uint64)) % np.uint64(SKETCH_BITS)
    odd = np.bincount(spots.astype(np.int64), minlength=SKETCH_BITS) % 2
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def similar(first: Column, second: Column) -> Column:
    """The similarity that two odd sketches tell; 0 if they differ in half of their bits or more."""
    words = SKETCH_BITS // 64
    differ = sum(
        (F.bit_count(F.get(first, F.lit(i)).bitwiseXOR(F.get(second, F.lit(i)))) for i in range(1, words)),
        F.bit_count(F.get(first, F.lit(0)).bitwiseXOR(F.get(second, F.lit(0)))),
    )
    rest = 1 - 2 * differ / SKETCH_BITS
    changed = -SKETCH_BITS / 2 * F.log(F.when(rest > 0, rest))
    return F.coalesce(1 - changed / (2 * SAMPLES), F.lit(0.0))


def signatures(docs: DataFrame, words: int, key: str, text: str) -> DataFrame:
    """(key, n_shingles, set_a, set_b, bands, sketch): numbers that stand for a row's set; NULL for an empty one."""

    def row(value: str | None) -> tuple:
        found = shingles(value, words)
        if not len(found):
            return 0, None, None, None, None
        a, b = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), np.int64).tolist()
        samples = min_hashes(found)
        return len(found), a, b, bands_of(samples), odd_sketch(samples)

    kinds = {"n_shingles": pa.int64(), "set_a": pa.int64(), "set_b": pa.int64(), "bands": pa.list_(pa.int64()), "sketch": pa.list_(pa.int64())}

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                found = zip(*map(row, part.column(text).to_pylist()))
                columns = [pa.array(values, kind) for values, kind in zip(found, kinds.values())]
                yield pa.RecordBatch.from_arrays([part.column(key), *columns], [key, *kinds])

    kind = dict(docs.dtypes)[key]
    schema = f"`{key}` {kind}, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, sketch array<bigint>"
    return docs.select(key, text).mapInArrow(batches, schema)


def confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int, key: str, text: str) -> DataFrame:
    """The different pairs (a, b) of which 100 * intersection >= percent * union holds on the full sets."""
    pairs = written(pairs, "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    texts = perhaps_in(docs.select(key, text), key, ids)
    left = texts.select(F.col(key).alias("a"), F.col(text).alias("text_a"))
    right = texts.select(F.col(key).alias("b"), F.col(text).alias("text_b"))

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            last, sets = None, []
            keep = []
            for one, two in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
                if one != last:
                    last, sets = one, shingles(one, words)
                other = shingles(two, words)
                common = len(np.intersect1d(sets, other, assume_unique=True))
                keep.append(bool(common) and 100 * common >= percent * (len(sets) + len(other) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("a", "b")], ["a", "b"])

    # Memory: a batch holds two texts a row.
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return written(both.mapInArrow(batches, "a bigint, b bigint"), "confirmed")


def near_duplicates(
    docs: DataFrame, words: int = WORD_SIZE, similarity: float = SIMILARITY, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_shingles, component_id, kept): components of documents whose sets are similar enough.

    `component_id` is the smallest key that links reach, `kept` tells the document that it belongs to. A document
    without words has an empty set and is linked with nothing. NULL counts as an empty text. Rows that share
    a key are one document, which has the links of all of them. Without a key a row is linked with nothing, has no
    component and is kept. Other columns are not read; an empty table gives an empty table. `key` is a bigint.
    """
    percent = round(100 * similarity)
    signed = written(signatures(docs, words, key, text), "signatures")
    sets = signed.where(F.col(key).isNotNull() & (F.col("n_shingles") > 0))
    equal = written(sets.groupBy("set_a", "set_b").agg(F.min(key).alias("least")), "equal-sets")
    nodes = sets.join(equal, ["set_a", "set_b"]).where(F.col(key) == F.col("least"))
    nodes = written(nodes.select(F.col(key).alias("id"), F.col("n_shingles").alias("n"), "bands", "sketch"), "nodes")

    banded = nodes.select("id", F.explode("bands").alias("band"))
    # The random member of a band is the one whose hash with the band is the smallest.
    turn = F.xxhash64("band", "id")
    crowded = banded.groupBy("band").agg(F.min("id").alias("centre"), F.max("id").alias("last"), F.min(turn).alias("turn"))
    crowded = written(crowded.where("centre < last").drop("last"), "crowded")
    members = written(banded.join(crowded, "band").withColumn("drawn", turn == F.col("turn")).drop("turn"), "members")

    sketches = nodes.select("id", "n", "sketch")

    def promising(pairs: DataFrame) -> DataFrame:
        one, two = (sketches.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}")) for s in "ab")
        sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
        near = similar(F.col("sketch_a"), F.col("sketch_b")) >= similarity - SLACK
        return pairs.join(one, "a").join(two, "b").where(sizes & near).select("a", "b")

    stars = members.where("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b"))
    drawn = written(members.where("drawn").select("band", F.col("id").alias("other")), "drawn")
    pairs = members.join(drawn, "band").where("id <> other").select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"))
    tried = written(promising(stars.union(pairs).distinct()), "tried")
    links = confirmed(tried, docs, words, percent, key, text)

    # A key whose rows have different sets joins these.
    of_key = written(sets.join(equal, ["set_a", "set_b"]).select(F.col(key).alias("id"), "least").distinct(), "keys")
    joined = of_key.where("id <> least").select(F.col("id").alias("a"), F.col("least").alias("b"))
    several = of_key.groupBy("id").agg(F.min("least").alias("low"), F.max("least").alias("high")).where("low < high")
    doubled = joined.join(several.select(F.col("id").alias("a")), "a", "left_semi")

    parts = components(links.union(doubled))
    rest = _apart(members, parts, sketches, percent, similarity)
    late = confirmed(rest.join(tried, ["a", "b"], "left_anti"), docs, words, percent, key, text)
    whole = joined_components(parts, late)

    reached = of_key.join(whole.withColumnRenamed("node", "least"), "least", "left")
    reached = reached.groupBy("id").agg(F.min(F.coalesce("component", "least")).alias("component_id"))
    reached = written(reached.select(F.col("id").alias("_id"), "component_id"), "reached")
    found = signed.select(key, "n_shingles").join(reached, F.col(key) == F.col("_id"), "left")
    component = F.coalesce("component_id", key)
    return found.select(key, "n_shingles", component.alias("component_id"), F.coalesce(component == F.col(key), F.lit(True)).alias("kept"))


def _apart(members: DataFrame, parts: DataFrame, sketches: DataFrame, percent: int, similarity: float) -> DataFrame:
    """Pairs of one band that are not in one component yet and that their sketches let pass.

    In each band, those outside of its largest component are compared with all that are in another one.
    """
    labels = parts.select(F.col("node").alias("id"), "component")
    placed = members.select("band", "id").join(labels, "id", "left").select("band", "id", F.coalesce("component", "id").alias("part"))
    placed = written(placed, "placed")
    sizes = placed.groupBy("band", "part").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("band").agg(F.max(F.struct("n", "part")).alias("main"), F.count("*").alias("parts")).where("parts > 1")
    mixed = written(mixed.select("band", F.col("main.part").alias("main")), "mixed")
    open_ = written(placed.join(mixed, "band").join(sketches, "id"), "open")
    cols = ("id", "part", "n", "sketch")
    outer = open_.where("part <> main").select("band", *[F.col(c).alias(f"{c}_a") for c in cols])
    every = open_.select("band", "main", *[F.col(c).alias(f"{c}_b") for c in cols])
    once = (F.col("part_b") == F.col("main")) | (F.col("id_a") < F.col("id_b"))
    fit = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    near = similar(F.col("sketch_a"), F.col("sketch_b")) >= similarity - SLACK
    found = outer.join(every, "band").where((F.col("part_a") != F.col("part_b")) & once & fit & near)
    return found.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()

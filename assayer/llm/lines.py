"""Line dedup by a segment-partition edit join, in DataFrame operations.

Two lines within `edits` edits of each other share, when the shorter is cut into `edits` + 1 segments, at
least one segment, which the longer holds near the same place. Every line puts its segments and the substrings
that may equal a segment of a line as long or a little shorter under a hash of (length, segment, substring).
Only hashes under which two different lines meet are looked at again; such lines are compared by a banded
bit-parallel edit distance. A line goes if it, or a line within `edits` edits of it, occurs in an earlier document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import SPACE, let, perhaps_in
from assayer.scratch import written

EDITS = 2
ONE_WORD = 30  # lines of one word with fewer characters stay: they repeat by chance


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _trim(line: Column) -> Column:
    """A line without the space around it. Trimming walks through a whole line, so only lines that may need it are trimmed."""
    ends = [line.endswith(c) for c in " \t\x0b\x0c\r"]
    around = reduce(Column.__or__, ends, line < "!")  # space sorts before all that is printed
    return F.when(around, F.btrim(line, F.lit(" \t\x0b\x0c\r"))).otherwise(line)


def _counts_as_line(line: Column, min_chars: int | None) -> Column:
    """Whether a trimmed line may go; without `min_chars` all but short ones of one word."""
    if min_chars is not None:
        return F.length(line) >= min_chars
    return (F.length(line) >= ONE_WORD) | line.rlike(f"[{SPACE}]")


def _lines(docs: DataFrame, key: str, text: str, min_chars: int | None) -> DataFrame:
    """(key, line_no, line, a, b): the lines that may go, trimmed, with a 128-bit hash."""
    each = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.posexplode(_split(F.col(text))).alias("line_no", "line"))
    found = each.withColumn("line", _trim(F.col("line"))).where(_counts_as_line(F.col("line"), min_chars))
    return found.withColumns({"a": F.xxhash64("line"), "b": F.xxhash64(F.lit(1), "line")})


def _segment(length: Column, i: Column, edits: int) -> tuple[Column, Column]:
    """Where segment i of a line begins, from 0, and how long it is; the last ones are the longer ones."""
    size, longer = F.floor(length / (edits + 1)).cast("int"), length % (edits + 1)
    ahead = F.greatest(longer - (edits + 1 - i), F.lit(0)).cast("int")
    return size * i + ahead, size + F.when(longer >= edits + 1 - i, 1).otherwise(0)


def _moves(i: int, edits: int) -> list[tuple[int, int]]:
    """(d, shift): how much shorter another line may be, and how far its segment i may stand from its place there.

    For segment i, counted from 0, and a difference d in length, edits before and after the segment bound how far
    it can have moved: by i edits at most if counted from the start, by edits - i if counted from the end.
    """
    ranges = {d: range(max(-i, d - (edits - i)), min(i, d + (edits - i)) + 1) for d in range(edits + 1)}
    return [(d, shift) for d, some in ranges.items() for shift in some]


def within(one: Column, two: Column, edits: int) -> Column:
    """Whether the edit distance of two strings longer than `edits` is at most `edits`.

    Bit-parallel in a band that slides along the diagonal with the characters of the second string. `vp` and `vn`
    tell where the distance rises and falls from one place of the band to the next; a step takes a few operations
    on one word. The distance is followed along the lowest diagonal of the band until that leaves
    the first string, and from there along the first string's last character.
    """
    top = 2 * edits + 1  # the bit of the lowest diagonal
    mask = F.lit((1 << (top + 1)) - 1).cast("bigint")
    none = lambda c: mask.bitwiseAND(F.bitwise_not(c))
    bit = lambda c, at: F.call_function("shiftright", c, at).bitwiseAND(F.lit(1)).cast("int")

    def run(s: Column) -> Column:
        first, second = s["first"], s["second"]
        straight = F.size(first) - edits  # steps along the diagonal

        def equal(j: Column) -> Column:
            here = F.get(second, j)
            bits = [F.when(F.get(first, j + edits - k) == here, F.lit(1 << (top - k))).otherwise(0) for k in range(2 * edits + 1)]
            return sum(bits[1:], bits[0]).cast("bigint")

        def step(a: Column, j: Column, score) -> Column:
            def zero(eq: Column) -> Column:
                risen = (eq.bitwiseAND(a["vp"]) + a["vp"]).bitwiseXOR(a["vp"])
                d0 = risen.bitwiseOR(eq).bitwiseOR(a["vn"]).bitwiseAND(mask)

                def moved(d0: Column) -> Column:
                    hp, hn = a["vn"].bitwiseOR(none(d0.bitwiseOR(a["vp"]))), d0.bitwiseAND(a["vp"])
                    below = F.shiftright(d0, 1)
                    return F.struct(
                        hn.bitwiseOR(none(below.bitwiseOR(hp))).alias("vp"),
                        below.bitwiseAND(hp).alias("vn"),
                        (a["far"] + score(d0, hp, hn)).alias("far"),
                    )

                return let(d0, moved)

            return let(equal(j), zero)

        def diagonal(a: Column, j: Column) -> Column:
            return step(a, j, lambda d0, hp, hn: 1 - bit(d0, F.lit(top)))

        def along(a: Column, j: Column) -> Column:
            at = (top - 1 - (j - straight)).cast("int")
            return step(a, j, lambda d0, hp, hn: bit(hp, at) - bit(hn, at))

        start = F.struct(
            F.lit(((1 << (edits + 1)) - 1) << (edits + 1)).cast("bigint").alias("vp"),
            F.lit(0).cast("bigint").alias("vn"),
            F.lit(edits).alias("far"),
        )
        rest = F.slice(F.sequence(straight, F.size(second) + 1), F.lit(1), F.size(second) - straight)
        down = F.aggregate(F.sequence(F.lit(0), straight - 1), start, diagonal)
        return F.aggregate(rest, down, along)["far"] <= edits

    lengths = F.abs(F.length(one) - F.length(two)) <= edits
    return F.when(lengths, let(F.struct(F.split(one, "").alias("first"), F.split(two, "").alias("second")), run)).otherwise(False)


# Letters counted to tell lines apart before their distance is computed; any would do.
_LETTERS = "etaonishrld "


def _counts(line: Column) -> Column:
    return F.array(*[F.length(line) - F.length(F.replace(line, F.lit(c), F.lit(""))) for c in _LETTERS])


def _alike(one: Column, two: Column, edits: int) -> Column:
    """An edit changes two counts by one at most."""
    changes = [F.abs(F.get(one, F.lit(i)) - F.get(two, F.lit(i))) for i in range(len(_LETTERS))]
    return sum(changes[1:], changes[0]) <= 2 * edits


def _hashes(lines: DataFrame, edits: int) -> DataFrame:
    """(a, hash, segment): a row for each substring of a line that may equal a segment of a line that is 0 to `edits`
    characters shorter. Those of its own segments, which have not moved, are marked.

    A line of ASCII characters is cut as bytes, at once; the pieces have the same hash as those of a text. Of other lines the
    part around a segment that its hashes need is counted and cut once, as both take a walk through the characters.
    A row for each hash, and not a column, keeps what Spark generates small enough to be compiled to machine code.
    """
    each = lines.select("a", "line", F.length("line").alias("n"))
    each = each.withColumn("raw", F.when(F.octet_length("line") == F.col("n"), F.col("line").cast("binary")))
    each = each.select("*", F.explode(F.array(*map(F.lit, range(edits + 1)))).alias("i"))
    start, size = _segment(F.col("n"), F.col("i"), edits)
    each = each.withColumns({"from": F.greatest(start - 2 * edits, F.lit(0)), "size": size + 4 * edits + 1})
    part = F.when(F.col("raw").isNull(), F.substring(F.col("line"), F.col("from") + 1, F.col("size")))
    each = each.select("a", "n", "raw", "i", "from", part.alias("part"))
    moves = [F.array(*[F.struct(F.lit(d).alias("d"), F.lit(shift).alias("shift")) for d, shift in _moves(i, edits)]) for i in range(edits + 1)]
    chosen = F.when(F.col("i") == 0, moves[0])
    for i in range(1, edits + 1):
        chosen = chosen.when(F.col("i") == i, moves[i])
    moved = each.select("*", F.explode(chosen).alias("move")).select("*", "move.*")
    start, size = _segment(F.col("n") - F.col("d"), F.col("i"), edits)
    moved = moved.withColumns({"at": start + F.col("shift"), "size": size}).where((F.col("at") >= 0) & (F.col("at") + F.col("size") <= F.col("n")))
    of = lambda piece: F.xxhash64(F.col("n") - F.col("d"), "i", piece)
    cut = of(F.substring(F.col("raw"), F.col("at") + 1, F.col("size")))
    walked = of(F.substring(F.col("part"), F.col("at") - F.col("from") + 1, F.col("size")))
    segment = (F.col("d") == 0) & (F.col("shift") == 0)
    return moved.select("a", F.when(F.col("raw").isNotNull(), cut).otherwise(walked).alias("hash"), segment.alias("segment"))


def near_lines(docs: DataFrame, places: DataFrame, edits: int, min_chars: int | None, key: str, text: str) -> DataFrame:
    """(a, b, since): lines that are within `edits` edits of a line that occurs first in an earlier
    document, and the first such document. `places` are the lines without their text."""
    long = F.length("line") > 2 * edits
    lines = _lines(docs, key, text, min_chars).where(long)
    hashes = written(_hashes(lines, edits), "line-hashes")
    met = hashes.groupBy("hash").agg(F.min("a").alias("low"), F.max("a").alias("high"), F.max("segment").alias("segment"))
    met = written(met.where((F.col("low") != F.col("high")) & F.col("segment")).select("hash"), "met")

    again = perhaps_in(hashes, "hash", met).groupBy("a", "hash", "segment").agg(F.count("*").alias("n")).drop("n")
    again = written(again, "hits")
    # A line's text is read in the first document that has it.
    first = perhaps_in(places, "a", again.select("a")).groupBy("a", "b").agg(F.min("key").alias("first"))
    first = written(first, "first-places")
    texts = _lines(perhaps_in(docs.select(key, text), key, first.select("first")), key, text, min_chars).where(long)
    texts = perhaps_in(texts.select("a", "b", "line"), "a", again.select("a")).groupBy("a", "b").agg(F.max("line").alias("line"))
    found = written(texts.join(first, ["a", "b"]).withColumn("counts", _counts(F.col("line"))), "candidates")
    entry = written(again.join(found, "a"), "entries")
    names = ("a", "b", "first", "line", "counts")
    one = entry.where("segment").select("hash", *[F.col(c).alias(f"{c}_1") for c in names])
    two = entry.select("hash", *[F.col(c).alias(f"{c}_2") for c in names])
    other = (F.col("a_1") != F.col("a_2")) | (F.col("b_1") != F.col("b_2"))
    # Of two lines of one length either finds the other; one way is enough.
    once = (F.length("line_1") != F.length("line_2")) | (F.struct("a_1", "b_1") < F.struct("a_2", "b_2"))
    apart = F.col("first_1") != F.col("first_2")
    alike = _alike(F.col("counts_1"), F.col("counts_2"), edits)
    pairs = one.join(two, "hash").where(other & once & apart & alike)
    pairs = pairs.dropDuplicates(["a_1", "b_1", "a_2", "b_2"]).drop("hash", "counts_1", "counts_2")
    links = written(pairs.where(within(F.col("line_1"), F.col("line_2"), edits)).drop("line_1", "line_2"), "line-links")
    later = F.col("first_1") < F.col("first_2")
    side = lambda c: F.when(later, F.col(f"{c}_2")).otherwise(F.col(f"{c}_1"))
    since = F.least("first_1", "first_2")
    return links.select(side("a").alias("a"), side("b").alias("b"), since.alias("since")).groupBy("a", "b").agg(F.min("since").alias("since"))


def gone_lines(docs: DataFrame, edits: int = EDITS, min_chars: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, gone): for documents that lose lines, an array of (line number from 0, hash of the line)."""
    if min_chars is not None and min_chars <= 2 * edits:
        raise ValueError("lines must be longer than twice the edits")
    narrow = written(_lines(docs, key, text, min_chars).select("key", "line_no", "a", "b"), "lines")
    repeated = narrow.groupBy("a", "b").agg(F.min("key").alias("since"), F.max("key").alias("last")).where("since < last").drop("last")
    since = repeated.union(near_lines(docs, narrow, edits, min_chars, key, text)).groupBy("a", "b").agg(F.min("since").alias("since"))
    since = written(since, "line-since")
    dropped = perhaps_in(narrow, "a", since.select("a")).join(since, ["a", "b"]).where("key > since")
    return written(dropped.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("line_no", "a"))).alias("gone")), "gone")


def dedup(docs: DataFrame, edits: int = EDITS, min_chars: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of `docs` with the lines taken out of `text`, and `n_lines` (lines that hold more than space,
    before), `n_gone` (those taken out), `gone_lines` (their numbers from 0, over all lines).

    Lines are parted by \\n and compared without the space around them. A line goes if an equal one occurs in a document
    with a smaller key, or one within `edits` edits, where both have more than 2 * `edits` characters. Lines of one word with
    fewer than `ONE_WORD` characters stay; with `min_chars`, lines with fewer characters stay instead of these.
    Repeats inside one document stay. Rows that share a key are one document. NULL keys come with no order: their rows are
    left as they are, and so are NULL texts. Columns of `docs` that have the added names give way.
    """
    gone = gone_lines(docs, edits, min_chars, key, text).select(F.col("key").alias("_key"), F.col("gone").alias("_gone"))
    counted = docs.withColumn("n_lines", F.coalesce(F.size(F.filter(_split(F.col(text)), lambda x: _trim(x) != "")), F.lit(0)).cast("bigint"))
    both = counted.join(gone, F.col(key) == F.col("_key"), "left")
    hit = lambda x, i: F.array_contains(F.col("_gone"), F.struct(i.cast("int").alias("line_no"), F.xxhash64(_trim(x)).alias("a")))
    left = F.array_join(F.filter(_split(F.col(text)), lambda x, i: ~hit(x, i)), "\n")
    numbers = F.coalesce(F.transform("_gone", lambda g: g["line_no"]), F.array().cast("array<int>"))
    added = {"n_gone": F.size(numbers).cast("bigint"), "gone_lines": numbers}
    out = both.withColumns(added).withColumn(text, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(left))
    return out.select(*[c for c in docs.columns if c not in ("n_lines", *added)], "n_lines", *added)

"""Personal data by bootstrapped contextual extraction.

Entities that regular expressions find are the seeds. The words around a seed are patterns; a
pattern is believed as far as the different values that stand in it are believed to be of one kind, and a
value as far as it stands in believed patterns. The graph of patterns and values is scored in
rounds; values of sufficient belief that no expression has found are added to the seeds' spans.
Everything is DataFrame operations: positions follow from the lengths of matches and of what
stands between them, and only tokens and runs of numbers that may be identifiers leave their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import SPACE, let
from assayer.scratch import written

KINDS = ("email", "ip", "card", "phone")
# The look-behinds let a match start where a run starts or where the last match ended, which is where
# the leftmost match starts; possessive loops keep long runs linear.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Tokens that may be identifiers: a digit or an @ in them.
TOKEN = rf"(?<![^{SPACE}])[^{SPACE}0-9@]*+[0-9@][^{SPACE}]*+"
# Numbers side by side, written with the characters of the phone and card expressions; those without a blank are tokens.
RUN = rf"(?<![^{SPACE}])[+(]*+[0-9]++(?:[\x20().-]++[0-9]++(?![A-Za-z0-9_@]))++"

CONTEXT = 80  # characters on either side in which the words of a pattern are looked for
MIN_SEEDS = 5  # different values that a pattern must have been seen with
MIN_PATTERN = 0.8  # belief of a pattern that counts
MIN_VALUE = 0.9  # belief of a value that becomes a span
ROUNDS = 3
WEAK_DIGITS = 5  # values with fewer digits and no @ are too common to tell their patterns anything
_BLOCK = 256


def _starts(lengths: Column) -> Column:
    """Sums of the elements before each one, in blocks, so that long arrays are not copied each time."""

    def sums(values: Column, base: Column) -> Column:
        zero = F.struct(base.alias("at"), F.array().cast("array<bigint>").alias("out"))
        add = lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out"))
        return F.aggregate(values, zero, add, lambda a: a["out"])

    def blocks(values: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _BLOCK).cast("int"))
        return F.transform(numbers, lambda b: F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)))

    def whole(cut: Column) -> Column:
        return F.transform(cut, lambda block: F.aggregate(block, F.lit(0).cast("bigint"), lambda a, x: a + x))

    return let(let(lengths, blocks), lambda cut: F.flatten(F.zip_with(cut, sums(whole(cut), F.lit(0).cast("bigint")), sums)))


def spans_of(text: Column, found: Column, pattern: str, kind: str) -> Column:
    """array of (start, kind, end, value) for the matches `found` of a pattern; ends are exclusive."""
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    pairs = F.zip_with(found, gaps, lambda m, g: F.struct(F.length(g).cast("bigint").alias("gap"), m.alias("value")))

    def span(pair: Column, before: Column) -> Column:
        start = before + pair["gap"]
        end = start + F.length(pair["value"])
        return F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), pair["value"].alias("value"))

    def spans(pairs: Column) -> Column:
        return F.zip_with(pairs, _starts(F.transform(pairs, lambda p: p["gap"] + F.length(p["value"]))), span)

    return let(pairs, spans)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def weigh(digit: Column, i: Column) -> Column:
        doubled = digit.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(doubled > 9, doubled - 9).otherwise(doubled)

    weighed = F.transform(F.split(F.reverse(digits), ""), weigh)
    return F.aggregate(weighed, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
    size = F.length(_digits(value))
    if kind == "ip":
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(size.between(12, 19), _luhn(_digits(value))).otherwise(False)
    return size.between(9, 15) if kind == "phone" else F.lit(True)


_SPAN = "array<struct<start: bigint, kind: string, end: bigint, value: string>>"


def _found(text: Column) -> dict[str, Column]:
    return {kind: F.regexp_extract_all(text, F.lit(pattern), F.lit(0)) for kind, pattern in PATTERNS.items()}


def base_spans(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """(keep.., text, base): the valid matches of each expression, by start and then by kind as listed."""
    body = F.coalesce(F.col(text), F.lit(""))
    matched = docs.select(*keep, body.alias("_text")).withColumns({f"_{k}": c for k, c in _found(F.col("_text")).items()})

    def spans(kind: str) -> Column:
        found = F.col(f"_{kind}")
        every = F.filter(spans_of(F.col("_text"), found, PATTERNS[kind], kind), lambda s: valid(kind, s["value"]))
        # Most texts hold none that is valid, and need no positions.
        return F.when(F.exists(found, lambda m: valid(kind, m)), every).otherwise(F.array().cast(_SPAN))

    order = F.create_map(*[F.lit(x) for pair in zip(KINDS, range(len(KINDS))) for x in pair])
    ranked = F.transform(
        F.concat(*[spans(kind) for kind in KINDS]), lambda s: F.struct(s["start"].alias("at"), order[s["kind"]].alias("rank"), s.alias("span"))
    )
    base = F.transform(F.array_sort(ranked), lambda x: x["span"])
    return matched.select(*keep, F.col("_text").alias("text"), base.alias("base"))


def _words(side: Column) -> Column:
    return F.filter(F.split(F.lower(side), f"[{SPACE}]+"), lambda w: w != "")


def _weak(value: Column) -> Column:
    return (F.length(_digits(value)) < WEAK_DIGITS) & ~F.contains(value, F.lit("@"))


def with_candidates(spans: DataFrame) -> DataFrame:
    """Adds `items`: the base spans, and outside of them runs of numbers and tokens like identifiers, with the words around."""
    text, base = F.col("text"), F.col("base")
    meets = lambda some, t: F.exists(some, lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"]))
    none = F.array().cast(_SPAN)

    def outside(name: str, pattern: str, also: Column) -> Column:
        found = spans_of(text, F.col(name), pattern, "")
        return F.when(F.size(name) > 0, F.filter(found, lambda t: ~meets(base, t) & also(t))).otherwise(none)

    def item(s: Column) -> Column:
        start = s["start"].cast("int")
        left = _words(F.substring(text, F.greatest(start - CONTEXT, F.lit(0)) + 1, F.least(start, F.lit(CONTEXT))))
        right = _words(F.substring(text, s["end"].cast("int") + 1, F.lit(CONTEXT)))
        one, two = F.get(left, F.size(left) - 1), F.get(left, F.size(left) - 2)
        after = F.get(right, F.lit(0))
        before = F.array(F.concat_ws(" ", two, one, F.lit("_")), F.concat_ws(" ", one, F.lit("_"), after))
        behind = F.array(F.concat_ws(" ", F.lit("_"), after, F.get(right, F.lit(1))))
        nothing = F.array().cast("array<string>")
        patterns = F.concat(F.when(one.isNotNull(), before).otherwise(nothing), F.when(after.isNotNull(), behind).otherwise(nothing))
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), F.lower(s["value"]).alias("value"),
            patterns.alias("patterns"), ((s["kind"] == "") & _weak(s["value"])).alias("weak"),
        )

    found = spans.withColumns({"_tokens": F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), "_numbers": F.regexp_extract_all(text, F.lit(RUN), F.lit(0))})
    found = found.withColumn("_runs", outside("_numbers", RUN, lambda t: F.contains(t["value"], F.lit(" "))))
    # What a run holds is part of it, but a token that could be an identifier of its own.
    new = F.concat(F.col("_runs"), outside("_tokens", TOKEN, lambda t: ~(_weak(t["value"]) & meets(F.col("_runs"), t))))
    return found.withColumn("items", F.transform(F.concat(base, new), item)).drop("_tokens", "_numbers", "_runs")


def believed(items: DataFrame, min_seeds: int = MIN_SEEDS, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(kind, value, belief) of values without a kind, after some rounds over the graph, and (pattern, kind, trust).

    An edge is a pattern and a different value in it, however often both occur together. A pattern's
    belief in a kind is the mean belief of its values; it counts from `MIN_PATTERN` and `min_seeds` values on.
    A value is believed as far as not all its patterns are wrong. A weak value is a value of its patterns, but not believed.
    """
    edges = written(
        items.select("kind", "value", "weak", F.explode("patterns").alias("pattern")).groupBy("pattern", "kind", "value", "weak").agg(F.count("*").alias("n")).drop("n"),
        "pii-edges",
    )
    beliefs = None
    for _ in range(rounds):
        each = edges.select("pattern", "value", "kind", F.when(F.col("kind") != "", 1.0).otherwise(0.0).alias("belief"))
        if beliefs is not None:
            known = beliefs.select("value", F.col("kind").alias("_kind"), F.col("belief").alias("_belief"))
            each = each.join(known, (each["value"] == known["value"]) & (each["kind"] == ""), "left").select(
                "pattern", each["value"], F.coalesce("_kind", "kind").alias("kind"), F.coalesce("_belief", "belief").alias("belief")
            )
        sums = [F.sum(F.when(F.col("kind") == k, F.col("belief")).otherwise(0.0)).alias(k) for k in KINDS]
        patterns = each.groupBy("pattern").agg(F.count("*").alias("values"), *sums)
        kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("sum")) for k in KINDS])
        good = patterns.select("pattern", "values", F.explode(kinds).alias("k")).where(
            (F.col("k.sum") >= min_seeds) & (F.col("k.sum") >= MIN_PATTERN * F.col("values"))
        )
        good = written(good.select("pattern", F.col("k.kind").alias("good"), (F.col("k.sum") / F.col("values")).alias("trust")), "pii-patterns")
        open_edges = edges.where("kind = '' and not weak").select("pattern", "value")
        doubt = F.sum(F.log(F.greatest(1 - F.col("trust"), F.lit(0.01))))
        beliefs = written(
            open_edges.join(good, "pattern").groupBy("value", F.col("good").alias("kind")).agg((1 - F.exp(doubt)).alias("belief")), "pii-values"
        )
    return beliefs, good.select("pattern", F.col("good").alias("kind"), "trust")


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", min_seeds: int = MIN_SEEDS, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, base, spans): arrays of (start, kind, end) by start and then by kind as listed.

    NULL is an empty text; an empty text has no spans. Every row is kept, repeated ones and those without
    a key as well; a value counts once for a pattern however many rows repeat it. Other columns are not
    read. An empty table gives an empty table.
    """
    base = with_candidates(base_spans(docs, [key], text))
    # Without the texts, and with a number for each row, fixed by writing it.
    rows = written(base.select(key, "base", "items").withColumn("row", F.monotonically_increasing_id()), "pii-spans")
    items = rows.select("row", F.explode("items").alias("i")).select("row", "i.*")
    beliefs, good = believed(items, min_seeds, rounds)
    best = beliefs.where(F.col("belief") >= MIN_VALUE).groupBy("value").agg(F.max(F.struct("belief", F.col("kind").alias("kind"))).alias("b"))
    new = items.where("kind = '' and not weak").select("row", "start", "end", "value").join(best.select("value", "b.kind"), "value").drop("value")
    # A weak value is one where it stands in patterns of that belief, and nowhere else.
    weak = items.where("weak").select("row", "start", "end", F.explode("patterns").alias("pattern")).join(good, "pattern")
    weak = weak.groupBy("row", "start", "end", "kind").agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("trust"), F.lit(0.01)))))).alias("belief"))
    weak = weak.where(F.col("belief") >= MIN_VALUE).groupBy("row", "start", "end").agg(F.max(F.struct("belief", "kind")).alias("b"))
    every = new.unionByName(weak.select("row", "start", "end", "b.kind"))
    added = every.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("all"))
    inside = lambda s, t: (t["start"] <= s["start"]) & (s["end"] <= t["end"]) & (t["end"] - t["start"] > s["end"] - s["start"])
    added = added.select("row", F.filter("all", lambda s: ~F.exists("all", lambda t: inside(s, t))).alias("added"))
    plain = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    order = F.create_map(*[F.lit(x) for pair in zip(KINDS, range(len(KINDS))) for x in pair])

    def by_start(spans: Column) -> Column:
        ranked = F.transform(spans, lambda s: F.struct(s["start"].alias("at"), order[s["kind"]].alias("rank"), s.alias("span")))
        return F.transform(F.array_sort(ranked), lambda x: x["span"])

    none = F.array().cast("array<struct<start: bigint, kind: string, end: bigint>>")
    every = F.when(F.col("added").isNull(), plain).otherwise(by_start(F.concat(plain, F.coalesce("added", none))))
    return rows.drop("items").join(added, "row", "left").select(key, plain.alias("base"), every.alias("spans"))


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and a hash of the base spans of each row, and all spans as text."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(key, *map(count, KINDS), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))

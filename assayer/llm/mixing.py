"""Mixes sources to target weights by a min-cost flow.

A document may belong to several sources. Documents are aggregated by the set of sources they belong
to (their pattern); a pattern supplies its words once for nothing, a second time at a cost and a
third time at a higher one. The flow routes these words to the sources' targets at the least cost of
repetition. Sources that share documents form one network, and networks are solved apart, each by
one task, which sees patterns and never documents. A pattern's flow is then turned into documents:
whole copies of all of them, and one more copy of those that come first in a seeded order.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import word_count
from assayer.llm.components import components
from assayer.operators.ranking import dense_codes
from assayer.scratch import written

WEIGHTS = (5, 2, 1)  # of the sources in order, repeating
COPIES = 3  # a document is taken as often at most
SEED = 42
_DIGITS = 4096  # parts of a pattern's seeded order that are narrowed down at a time


def weighed_sources(sized: DataFrame, weights: Sequence[float] = WEIGHTS, copies: int = COPIES) -> DataFrame:
    """(source, source_size, target) of each source; NULL is a source of its own, the last one.

    Sources in code point order take `weights` in turn, and the targets share the size of all. A
    target stops at `copies` times its source's size, and the excess is shared by weight again.
    """
    sizes = written(sized.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size")), "source-sizes")
    codes = dense_codes(sizes, "source", "code")
    n = sizes.where(F.col("source").isNotNull()).count()
    turn = F.coalesce(F.col("code"), F.lit(n).cast("bigint")) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    sources = written(
        sizes.join(codes, "source", "left").select("source", "source_size", weight.alias("weight")), "source-weights"
    )
    most = F.col("source_size") * copies
    level, total = 0.0, sources.agg(F.sum("source_size")).first()[0] or 0
    while True:  # the level rises, so every round but the last caps a further source
        capped = F.col("weight") * level >= most
        left = sources.agg(
            F.sum(F.when(capped, most).otherwise(0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))
        ).first()
        reached = (total - (left[0] or 0)) / left[1] if left[1] else level
        if reached <= level:
            break
        level = reached
    target = F.least(F.col("weight") * level, most.cast("double"))
    return sources.select("source", "source_size", target.alias("target"))


def min_cost_flow(supplies: dict[tuple, int], demands: dict, copies: int = COPIES) -> dict[tuple, dict]:
    """Words that go from each pattern to each of its sources.

    A pattern has `copies` arcs of its own size with rising unit costs, so the flow repeats a pattern
    only when nothing cheaper reaches the target. Successive shortest paths: every path is either
    direct or moves words that another source has, in exchange for words of a cheaper pattern.
    """
    flow = {p: dict.fromkeys(p, 0.0) for p in supplies}
    used = dict.fromkeys(supplies, 0.0)
    need = {s: float(v) for s, v in demands.items()}
    of_source: dict = {s: [] for s in demands}
    for p in supplies:
        for s in p:
            of_source[s].append(p)
    tiny = 1e-9 * (1 + sum(need.values()))
    for source in sorted(demands, key=str):
        while need[source] > tiny:
            path = _cheapest(source, supplies, used, flow, of_source, copies, tiny)
            if path is None:
                break
            amount = min(need[source], _room(path[-1][1], supplies, used, copies))
            for s, p in path[1:]:  # the words that the exchange takes away from s
                amount = min(amount, flow[path[path.index((s, p)) - 1][1]][s])
            for i, (s, p) in enumerate(path):
                flow[p][s] += amount
                if i:
                    flow[path[i - 1][1]][s] -= amount
            used[path[-1][1]] += amount
            need[source] -= amount
    return flow


def _level(p: tuple, supplies: dict, used: dict) -> int:
    return int(used[p] / supplies[p] + 1e-12) if supplies[p] else COPIES


def _room(p: tuple, supplies: dict, used: dict, copies: int) -> float:
    """Words of a pattern that cost the same as the next one."""
    return supplies[p] * (_level(p, supplies, used) + 1) - used[p]


def _cheapest(source, supplies, used, flow, of_source, copies, tiny):
    """Steps (source, pattern) of the cheapest path, the shortest among equals: each takes from its
    pattern what the step before gives back."""
    best, queue, seen = None, [(0, 0, [], source)], set()
    while queue:
        length, tie, steps, at = heapq.heappop(queue)
        if at in seen:
            continue
        seen.add(at)
        for p in of_source[at]:
            level = _level(p, supplies, used)
            if supplies[p] and level < copies and _room(p, supplies, used, copies) > tiny:
                found = (level, length, [*steps, (at, p)])
                if best is None or found[:2] < best[:2]:
                    best = found
            for other in p:
                if other not in seen and flow[p][other] > tiny:
                    tie += 1
                    heapq.heappush(queue, (length + 1, len(seen) * 1_000_000 + tie, [*steps, (at, p)], other))
    return best[2] if best else None


def route(patterns: DataFrame, targets: DataFrame, copies: int = COPIES) -> DataFrame:
    """(pattern, words): the words that each pattern gives, by one min-cost flow for each network.

    `patterns` has (pattern array<string>, supply), `targets` has (source, target).
    """
    key = F.xxhash64  # a source's node; NULL has a node as well
    nodes = patterns.select(F.transform("pattern", lambda s: key(s, s.isNull())).alias("nodes"))
    edges = nodes.select(F.element_at("nodes", 1).alias("a"), F.explode("nodes").alias("b")).where("a <> b")
    networks = components(edges.distinct())
    of_pattern = patterns.withColumn(
        "node", key(F.element_at("pattern", 1), F.element_at("pattern", 1).isNull())
    ).join(networks, "node", "left")
    named = of_pattern.select("pattern", "supply", F.coalesce("component", "node").alias("network"))
    wanted = named.select("network", F.explode("pattern").alias("source")).distinct().join(
        targets.select(F.col("source").alias("_s"), "target"), F.col("source").eqNullSafe(F.col("_s"))
    )

    def solve(supplied: pd.DataFrame, demanded: pd.DataFrame) -> pd.DataFrame:
        supplies = {tuple(p): int(w) for p, w in zip(supplied["pattern"], supplied["supply"])}
        demands = {None if pd.isna(s) else s: t for s, t in zip(demanded["source"], demanded["target"])}
        flow = min_cost_flow(supplies, demands, copies)
        return pd.DataFrame({"pattern": [list(p) for p in flow], "words": [float(sum(f.values())) for f in flow.values()]})

    return (
        named.groupBy("network")
        .cogroup(wanted.select(F.col("network").alias("_network"), "source", "target").groupBy("_network"))
        .applyInPandas(solve, "pattern array<string>, words double")
    )


def cuts(sized: DataFrame, flows: DataFrame) -> DataFrame:
    """(pattern, full, low, fill, fill_size): the whole copies that a pattern's flow makes, and where in the pattern's
    seeded order one more ends: before `low`, and with one row that fills the rest best.

    The order is that of a seeded hash. Sums by parts of the hash tell in which part the flow ends,
    and sums within that part where exactly, so that no task ever sees all rows of a pattern.
    """
    supply = sized.groupBy("pattern").agg(F.sum("size").cast("double").alias("supply"))
    full = F.floor(F.col("words") / F.col("supply") + 1e-9)
    rest = supply.join(flows, "pattern").select(
        "pattern",
        F.when(F.col("supply") > 0, full).otherwise(0).cast("bigint").alias("full"),
        F.when(F.col("supply") > 0, F.col("words") - full * F.col("supply")).otherwise(0.0).alias("rest"),
    )
    rest = written(rest, "flows")
    # Three times the part of the hash in which the sum passes the rest, and what comes before it.
    ends = rest.select("pattern", "rest", F.lit(0).cast("bigint").alias("low"), F.lit(2**60).cast("bigint").alias("width"))
    for _ in range(3):
        inside = sized.join(ends, "pattern").where((F.col("code") >= F.col("low")) & (F.col("code") < F.col("low") + F.col("width")))
        part = F.expr(f"(code - low) div (width div {_DIGITS})")
        sums = inside.groupBy("pattern", "rest", "low", "width", part.alias("part")).agg(F.sum("size").alias("size"))
        ahead = F.collect_list(F.struct("part", "size"))  # one entry for each part, `_DIGITS` at most
        zero = F.struct(F.lit(-1).cast("bigint").alias("part"), F.col("rest").alias("rest"), F.lit(False).alias("found"))
        walk = F.aggregate(F.array_sort("parts"), zero, _step)
        ends = written(
            sums.groupBy("pattern", "rest", "low", "width")
            .agg(ahead.alias("parts"))
            .withColumn("end", walk)
            .select(
                "pattern",
                F.when(F.col("end.found"), F.col("end.rest")).otherwise(0.0).alias("rest"),
                F.when(F.col("end.found"), F.col("low") + F.col("end.part") * F.expr(f"width div {_DIGITS}"))
                .otherwise(F.col("low") + F.col("width")).alias("low"),
                F.expr(f"width div {_DIGITS}").alias("width"),
            ),
            "flow-ends",
        )
    # What is left is less than the next row in the order; the row of the nearest size fills it best.
    off = F.abs(F.col("size") - F.col("rest"))
    beyond = sized.join(ends, "pattern").where((F.col("code") >= F.col("low")) & (off < F.col("rest")))
    fillers = beyond.groupBy("pattern").agg(F.min(F.struct(off.alias("off"), "code", "size")).alias("filler"))
    ends = ends.join(fillers, "pattern", "left").select(
        "pattern", "low", F.col("filler.code").alias("fill"), F.col("filler.size").alias("fill_size")
    )
    return written(rest.select("pattern", "full").join(ends, "pattern", "left"), "flow-cuts")


def select(sized: DataFrame, flows: DataFrame) -> DataFrame:
    """Adds `copies`: the whole copies that a pattern's flow makes, and one more of the rows that come
    first in the pattern's seeded order for as long as they fit, and of one that fills the rest best."""
    return _counted(sized, cuts(sized, flows), F.col("size"))


def _counted(rows: DataFrame, ends: DataFrame, size: Column) -> DataFrame:
    """Adds `copies` to rows with `pattern` and `code`, by the `cuts` of their patterns; `size` is only looked at where a
    row may be the one that fills a rest."""
    filling = (F.col("code") == F.col("fill")) & (size == F.col("fill_size"))
    once = F.coalesce((F.col("code") < F.col("low")) | filling, F.lit(False))
    found = rows.join(ends, "pattern", "left")
    return found.withColumn("copies", F.coalesce("full", F.lit(0)) + once.cast("bigint")).drop("full", "low", "fill", "fill_size")


def _step(at: Column, part: Column) -> Column:
    """Goes past a part whose size fits into the rest, and stays in the first that does not."""

    def state(part: Column, rest: Column, found: Column) -> Column:
        return F.struct(part.alias("part"), rest.alias("rest"), found.alias("found"))

    here = state(part["part"], at["rest"], F.lit(True))
    past = state(at["part"], at["rest"] - part["size"], F.lit(False))
    return F.when(at["found"], at).when(part["size"] > at["rest"], here).otherwise(past)


def _placed(sources: Column, key: str, text: str, seed: int) -> tuple[Column, Column]:
    """(pattern, code) of a row."""
    pattern = F.coalesce(F.array_sort(F.array_distinct(sources)), F.array(F.lit(None).cast("string")))
    code = F.pmod(F.xxhash64(F.lit(seed), key, F.xxhash64(F.coalesce(text, F.lit("")))), F.lit(2**60))
    return pattern.alias("pattern"), code.alias("code")


def measured(docs: DataFrame, sources: Column, key: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """(doc_id, pattern, size, code): the narrow table that every later step reads, written once.

    `sources` is an array; its order and repeats do not matter, and a NULL array means a NULL source.
    """
    pattern, code = _placed(sources, key, text, seed)
    return written(docs.select(F.col(key), pattern, word_count(F.col(text)).alias("size"), code), "sizes")


def _solved(docs: DataFrame, weights: Sequence[float], copies: int, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sizes of documents, the targets of sources and the cuts of patterns."""
    sized = measured(docs, F.array("source"), key)
    single = F.element_at("pattern", 1)
    targets = written(weighed_sources(sized.select(single.alias("source"), "size"), weights, copies), "targets")
    patterns = sized.groupBy("pattern").agg(F.sum("size").cast("bigint").alias("supply"))
    return sized, targets, cuts(sized, written(route(patterns, targets, copies), "routes"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, copies: int = COPIES, key: str = "doc_id") -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) of a table with one `source` for each row.

    Without words a document is taken as often as its order says and counts nothing. A NULL text has
    no words, a NULL source is a source of its own. Rows that repeat key and text stand together in the
    seeded order. An empty table gives an empty table. The same rows give the same mix.
    """
    sized, targets, ends = _solved(docs, weights, copies, key)
    chosen = _counted(sized, ends, F.col("size"))
    by_source = targets.withColumn("pattern", F.array("source")).drop("source")
    return chosen.join(by_source, "pattern", "left").select(
        key, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, copies: int = COPIES, key: str = "doc_id") -> DataFrame:
    """The rows of `docs`, each as often as `mix` takes it; rows that share a key are taken alike, as often as the one
    that is taken most.

    A row tells its place in the order itself, so whole rows meet tables of a row for each source, and of the keys
    whose rows stand apart in the order, but are not shuffled to meet their copies.
    """
    sized, _, ends = _solved(docs, weights, copies, key)
    by_key = _counted(sized, ends, F.col("size")).groupBy(F.col(key).alias("_key"))
    by_key = by_key.agg(F.min("copies").alias("_least"), F.max("copies").alias("_most"))
    unlike = written(by_key.where("_least < _most").drop("_least"), "unlike-copies")
    pattern, code = _placed(F.array("source"), key, "text", SEED)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(whole, F.col(key).alias("_of"), F.col("text").alias("_text"), pattern, code)
    found = _counted(rows, ends, word_count(F.col("_text"))).join(unlike, F.col("_of").eqNullSafe(F.col("_key")), "left")
    found = found.select("_row", F.coalesce("_most", "copies").cast("int").alias("_copies")).where("_copies > 0")
    return found.select("_row", F.explode(F.sequence(F.lit(1), "_copies"))).select("_row.*")

"""Preference pairs of conversations: one prompt, two masked completions.

The turns that a chosen and a rejected conversation share from the start are rendered once as the prompt;
what follows in each is its completion. A mask tells which characters of a completion are learned
from: the texts of the assistant's turns and the mark that ends them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, BODY, END = "<|im_start|>", "\n", "<|im_end|>\n"
ASSISTANT = "assistant"


def turns(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, turns): the (role, text) of each conversation by turn, ties by role and text; NULL role or text is
    empty, a NULL turn is the last. A turn that a conversation holds twice, alike in all three, counts once."""
    turn = F.struct(
        F.col("turn").isNull().alias("late"), F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    listed = conversations.groupBy(key).agg(F.array_sort(F.collect_set(turn)).alias("t"))
    return listed.select(key, F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit(BODY), turn["text"], F.lit(END))


def _spans(completion: Column) -> Column:
    """(start, end) of what is learned from, in code points, the end exclusive."""

    def step(a: Column, turn: Column) -> Column:
        head = a["at"] + F.length(turn["role"]) + len(START) + len(BODY)
        stop = head + F.length(turn["text"]) + len(END)
        span = F.array(F.struct(head.alias("start"), stop.alias("end")))
        learned = F.when(turn["role"] == ASSISTANT, F.concat(a["out"], span)).otherwise(a["out"])
        return F.struct(stop.alias("at"), learned.alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, end: int>>").alias("out"))
    return F.aggregate(completion, zero, step, lambda a: a["out"])


def preferences(pairs: DataFrame, listed: DataFrame, key: str = "conv_id") -> DataFrame:
    """(pair_id, prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask) for pairs (pair_id, chosen_id, rejected_id).

    `prompt_turns` is the length of the longest common prefix. A conversation that is not there has no turns, and
    its completion is empty; equal conversations are all prompt. Every pair is kept, also with NULL ids.
    """
    sides = [listed.select(F.col(key).alias(f"{side}_id"), F.col("turns").alias(f"_{side}")) for side in ("chosen", "rejected")]
    both = pairs.select("pair_id", "chosen_id", "rejected_id").join(sides[0], "chosen_id", "left").join(sides[1], "rejected_id", "left")
    return _format(both)


def neighbours(listed: DataFrame, key: str = "conv_id") -> DataFrame:
    """The same for conversations 2n (chosen) and 2n + 1 (rejected), which is pair n; one shuffle, and a pair
    with one conversation is kept. A NULL key belongs to no pair."""
    side = F.pmod(F.col(key), F.lit(2)) == 0
    pairs = listed.where(F.col(key).isNotNull()).groupBy(F.expr(f"floor({key} / 2)").cast("bigint").alias("pair_id")).agg(
        F.flatten(F.collect_list(F.when(side, F.col("turns")))).alias("_chosen"),
        F.flatten(F.collect_list(F.when(~side, F.col("turns")))).alias("_rejected"),
    )
    return _format(pairs)


def _format(pairs: DataFrame) -> DataFrame:
    none = F.array().cast("array<struct<role: string, text: string>>")
    both = pairs.withColumns({c: F.coalesce(c, none) for c in ("_chosen", "_rejected")})
    same = F.transform(F.arrays_zip("_chosen", "_rejected"), lambda z: F.coalesce(z["_chosen"] == z["_rejected"], F.lit(False)))
    first = F.array_position(same, False)  # 0 if all turns are alike
    both = both.withColumn("n", F.when(first == 0, F.size("_chosen")).otherwise(first - 1).cast("int"))

    def rest(side: str) -> Column:
        return F.slice(side, F.col("n") + 1, F.greatest(F.size(side) - F.col("n"), F.lit(0)))

    both = both.withColumns({"_chosen_rest": rest("_chosen"), "_rejected_rest": rest("_rejected")})
    text = lambda c: F.array_join(F.transform(c, _rendered), "")
    return both.select(
        "pair_id",
        F.col("n").alias("prompt_turns"),
        text(F.slice("_chosen", F.lit(1), F.col("n"))).alias("prompt"),
        text(F.col("_chosen_rest")).alias("chosen"),
        _spans(F.col("_chosen_rest")).alias("chosen_mask"),
        text(F.col("_rejected_rest")).alias("rejected"),
        _spans(F.col("_rejected_rest")).alias("rejected_mask"),
    )

"""Preference formatting of chosen and rejected conversations, DataFrame operations only.

For a pair of conversations the longest common prefix of turns (equal role and text) is
rendered once as the prompt; the rest of each is its completion. A completion carries a
mask: the character spans of its assistant turns, on which a model is to be trained.

A conversation is rendered as one text, so its turns meet in one row; nothing larger is
collected. One conversation may stand in a third of the pairs: the joins split it.

Defined results: turns are ordered by (turn, role, text), so ties and repeated rows have
a fixed order and all stay. Null roles and texts are empty, a null turn comes first.
Pairs that name a missing or null conversation give no row; two equal conversations give
empty completions. Extra columns of conversations are not read, those of pairs stay.
Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vellumflow.operators.joins import lookup

START, AFTER_ROLE, END = "<|", "|>\n", "\n"
TRAINED_ROLE = "assistant"
ADDED = ("n_common", "prompt", "chosen", "rejected", "chosen_mask", "rejected_mask")


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the ordered turns of every conversation."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return conversations.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def common_turns(a: Column, b: Column) -> Column:
    """Number of leading turns with equal role and text."""
    shorter = F.least(F.size(a), F.size(b))
    differs = lambda i: (F.get(a, i)["role"] != F.get(b, i)["role"]) | (F.get(a, i)["text"] != F.get(b, i)["text"])
    first = F.get(F.filter(F.sequence(F.lit(0), shorter - 1), differs), F.lit(0))
    return F.when(shorter > 0, F.coalesce(first, shorter)).otherwise(F.lit(0))


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit(AFTER_ROLE), turn["text"], F.lit(END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def mask(turns: Column) -> Column:
    """(start, end) of the text and end mark of every assistant turn in the rendered turns."""
    def step(acc: Column, turn: Column) -> Column:
        begin = acc["at"] + F.length(F.concat(F.lit(START), turn["role"], F.lit(AFTER_ROLE)))
        end = acc["at"] + F.length(_rendered(turn))
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(turn["role"] == TRAINED_ROLE, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return F.aggregate(turns, empty, step)["spans"]


def format_pairs(conversations: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs`` (chosen_id, rejected_id, ...) with n_common, prompt, chosen, rejected and masks."""
    kept = [F.col(f"`{c}`") for c in pairs.columns if c not in ADDED]
    turns = turns_of(conversations)
    rows = pairs.select(*kept).withColumn("_row", F.monotonically_increasing_id())
    for side in ("chosen", "rejected"):
        rows = lookup(rows, turns.select(F.col("conv_id").alias(f"{side}_id"), F.col("turns").alias(f"_{side}")), [f"{side}_id"], "inner", "_row")
    rows = rows.withColumn("n_common", common_turns(F.col("_chosen"), F.col("_rejected")).cast("long"))
    n = F.col("n_common").cast("int")
    rest = {s: F.slice(F.col(f"_{s}"), n + 1, F.greatest(F.size(f"_{s}"), F.lit(1))) for s in ("chosen", "rejected")}
    return rows.select(
        *kept, "n_common", render(F.slice("_chosen", F.lit(1), n)).alias("prompt"),
        *[render(rest[s]).alias(s) for s in rest], *[mask(rest[s]).alias(f"{s}_mask") for s in rest],
    )

"""Preference formatting: a shared prompt, then the chosen and the rejected completion.

DataFrame functions only.  The longest common turn prefix of the two
conversations is rendered once; what follows on either side is its completion,
with runs of characters that say where loss is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def head(turn: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), F.coalesce(turn["role"], F.lit("")), F.lit("\n"))


def body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit("<|im_end|>\n"))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(head(t), body(t))), "")


def runs(turns: Column, trained: str) -> Column:
    """For each turn two runs (characters, train): its head, then its text with
    the end mark, trained where the role is ``trained``."""
    pair = lambda t: F.array(
        F.struct(F.length(head(t)).alias("chars"), F.lit(False).alias("train")),
        F.struct(F.length(body(t)).alias("chars"), F.coalesce(t["role"] == trained, F.lit(False)).alias("train")),
    )
    return F.flatten(F.transform(turns, pair))


def format_preferences(turns: DataFrame, pair_id: str = "pair_id", side: str = "side", turn: str = "turn", role: str = "role", text: str = "text", trained: str = "assistant") -> DataFrame:
    """One row per pair: pair_id, prompt_turns, prompt, chosen, chosen_runs,
    rejected and rejected_runs.

    ``turns`` has one row per turn with side "chosen" or "rejected".  Turns
    stand in order of (turn, role, text), nulls first, so repeated turn numbers
    have a defined order and repeated rows are turns of their own.  Null roles
    and texts render as empty; two nulls are equal.  A pair with one side has an
    empty prompt and null on the other side.  Rows with a null pair_id or
    another side belong to no pair.  A pair is one row of output, so its two
    conversations must fit in memory; nothing else is gathered.
    """
    own = turns.where(F.col(pair_id).isNotNull() & F.col(side).isin("chosen", "rejected"))
    item = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    gather = lambda s: F.sort_array(F.collect_list(F.when(F.col(side) == s, item)))
    both = own.groupBy(F.col(pair_id).alias("pair_id")).agg(gather("chosen").alias("c"), gather("rejected").alias("r"))
    same = F.zip_with("c", "r", lambda a, b: a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]))
    least = F.least(F.size("c"), F.size("r"))
    differs = F.array_position(F.slice(same, F.lit(1), least), False).cast("int")
    both = both.withColumn("prompt_turns", F.when(differs > 0, differs - 1).otherwise(least))
    rest = lambda c: F.slice(F.col(c), F.col("prompt_turns") + 1, F.size(c))
    there = lambda c, x: F.when(F.size(c) > 0, x)
    return both.select(
        "pair_id", "prompt_turns", rendered(F.slice("c", F.lit(1), F.col("prompt_turns"))).alias("prompt"),
        there("c", rendered(rest("c"))).alias("chosen"), there("c", runs(rest("c"), trained)).alias("chosen_runs"),
        there("r", rendered(rest("r"))).alias("rejected"), there("r", runs(rest("r"), trained)).alias("rejected_runs"),
    )

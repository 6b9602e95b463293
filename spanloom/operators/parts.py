"""Long recordings labelled in parts: shared windows, one reading from several, subgoals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from spanloom.session import stored

#: Relations of a part to the goal, the one that decides first.
OFF_GOAL, ON_GOAL = ["unrelated", "different"], ["narrower", "aligned", "broader"]
#: The most that an outcome is worth.
OUTCOME_CAPS = {"success": 1.0, "success_then_undone": 0.7, "partial": 0.9, "failure": 0.4}


def own_half(items: DataFrame, lo: Column, hi: Column, start: str = "s", end: str = "e") -> DataFrame:
    """Items cut to [lo, hi), their part's own side of the windows that it shares with its
    neighbours (null: no neighbour); clipped says whether one was cut, others go."""
    a, b = F.greatest(F.col(start), lo), F.least(F.col(end), hi)
    d = items.withColumns({"_a": a, "_b": b}).where("_a < _b")
    return d.withColumn("clipped", (F.col("_a") != F.col(start)) | (F.col("_b") != F.col(end))).withColumns({start: F.col("_a"), end: F.col("_b")}).drop("_a", "_b")


def open_at_cut(outcome: Column, end: Column, cut: Column, guard: float) -> Column:
    """An unfinished outcome of an item that ends at its part's inner cut is unclear."""
    return F.when(outcome.isin("partial", "failure", "unclear") & (end >= cut - guard), "unclear").otherwise(outcome)


def goal_alignment(parts: DataFrame, key: str, relation: str, matches: str, count: str) -> DataFrame:
    """key, relation and matches of a whole recording from its parts' readings.

    A part off the goal that doesn't match decides, the more severe first.  Else every
    one of ``count`` parts must be on the goal and not deny the match: then the first of
    ON_GOAL that any part reads.  Else both are null.
    """
    r = F.lower(F.trim(relation))
    first = lambda names: F.coalesce(*(F.when(F.max((r == n).cast("int")) == 1, n) for n in names))
    off = r.isin(OFF_GOAL) & (F.col(matches) == F.lit(False))
    severe = F.coalesce(*(F.when(F.max((off & (r == n)).cast("int")) == 1, n) for n in OFF_GOAL))
    on = (F.count_if(r.isin(ON_GOAL) & F.coalesce(F.col(matches), F.lit(True))) == F.max(count)) & (F.count(r) == F.max(count))
    out = parts.groupBy(key).agg(severe.alias("_off"), on.alias("_on"), first(ON_GOAL).alias("_first"))
    return out.select(key, F.coalesce("_off", F.when(F.col("_on"), F.col("_first"))).alias("relation"), F.when(F.col("_off").isNotNull(), False).when(F.col("_on"), True).alias("matches"))


def goal_outcome(parts: DataFrame, key: str, part: str, outcome: str, done: str) -> DataFrame:
    """key, outcome and done_at of a whole recording: the last part's outcome, unclear where a
    part gave none or an earlier one saw the goal reached that the last one doesn't.  A
    success is dated by the earliest part of the successes that end with the last."""
    back = Window.partitionBy(key).orderBy(F.desc(part))
    d = parts.withColumn("_gap", F.sum((~F.coalesce(F.col(outcome) == "success", F.lit(False))).cast("int")).over(back))
    reached = F.col(outcome).isin("success", "success_then_undone")
    g = d.groupBy(key).agg(
        F.max_by(F.struct(outcome), part).alias("_last"),
        F.count_if(F.col(outcome).isNull()).alias("_silent"),
        F.count_if(reached).alias("_reached"),
        F.min(F.when(F.col("_gap") == 0, F.col(done))).alias("_done"),
    )
    last = F.col(f"_last.{outcome}")
    unclear = (F.col("_silent") > 0) | (~last.isin("success", "success_then_undone") & (F.col("_reached") > 0))
    result = F.when(unclear, "unclear").otherwise(last)
    return g.select(key, result.alias("outcome"), F.when(result == "success", F.col("_done")).alias("done_at"))


def outcome_score(outcome: Column, progress: Column) -> Column:
    """10 for a success, else ten times the progress up to the outcome's cap; null where the
    outcome isn't settled or has no progress."""
    cap = F.coalesce(*(F.when(outcome == k, v) for k, v in OUTCOME_CAPS.items()), F.lit(None).cast("double"))
    return 10 * F.when(outcome == "success", 1.0).when(cap.isNotNull() & progress.isNotNull(), F.least(cap, progress))


def stretches(events: DataFrame, keys: list[str], t: str, goal: Column) -> DataFrame:
    """``events`` with stretch: the number (from 0) of goals before it in its key, so that
    each goal ends its own stretch."""
    w = Window.partitionBy(*keys).orderBy(t).rowsBetween(Window.unboundedPreceding, -1)
    return events.withColumn("stretch", F.coalesce(F.sum(goal.cast("int")).over(w), F.lit(0)))


def agreed(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, value where all claims that aren't null agree (else null), and claims, how many
    different ones there are."""
    g = df.groupBy(*keys).agg(F.min(value).alias(value), F.max(value).alias("_most"), F.countDistinct(value).alias("claims"))
    return g.withColumn(value, F.when(F.col("claims") == 1, F.col(value))).drop("_most")


def roots(edges: DataFrame) -> DataFrame:
    """node and root for every node of a map (long columns node, to; one row a node): the end
    of its chain, or where the chain runs into a circle the circle's first node on it.

    Pointers double, so a chain of n nodes takes about log n joins.  What is left after
    as many steps as there are nodes leads into circles, and the nodes reached there
    are their members; with these as ends the doubling runs once more.  No join broadcasts:
    in every round the map would pass through the driver once more.
    """
    start = stored(edges.where("node <> to").select("node", "to"), "map")

    def doubled(pointers: DataFrame, most: int) -> DataFrame:
        step = 1
        while step < 2 * most:
            ahead = pointers.select(F.col("node").alias("_n"), F.col("to").alias("_t"))
            met = pointers.join(ahead.hint("merge"), F.col("to") == F.col("_n"), "left")
            if met.where("_t is not null and _t <> to").isEmpty():
                break
            pointers, step = stored(met.select("node", F.coalesce("_t", "to").alias("to")), "map"), 2 * step
        return pointers

    ends = doubled(start, start.count())
    members = stored(ends.join(start.select(F.col("node").alias("to")).hint("merge"), "to", "left_semi").select(F.col("to").alias("node")).distinct(), "circles")
    open_ = stored(start.join(members.hint("merge"), "node", "left_anti"), "map")
    chains = doubled(open_, open_.count())
    return chains.select("node", F.col("to").alias("root")).unionByName(members.select("node", F.col("node").alias("root")))


def part_windows(frames: DataFrame, cuts: DataFrame, keys: list[str], place: str, t: str, overlap: float) -> DataFrame:
    """keys, cut (its frame), first and last: the frames that the two parts at a cut share,
    those within half of ``overlap`` of the cut's time and no further than halfway to the
    cut before and after it.

    frames: ``place`` (from 0 in its key) and ``t``, both ascending; cuts: keys and
    ``place``.  Times are counted by one union and one window, not by pairs.
    """
    c = cuts.join(frames.select(*keys, place, t), [*keys, place]).select(*keys, F.col(place).alias("cut"), F.col(t).alias("_t"))
    probe = lambda by, side: c.select(*keys, "cut", (F.col("_t") + by).alias("_at"), F.lit(side).alias("_side"))
    marks = frames.select(*keys, F.lit(None).cast("long").alias("cut"), F.col(t).alias("_at"), F.lit(0).alias("_side"))
    both = marks.unionByName(probe(-overlap / 2 - 1e-9, -1)).unionByName(probe(overlap / 2 + 1e-9, 1))
    w = Window.partitionBy(*keys).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    counted = both.withColumn("_n", F.count(F.when(F.col("_side") == 0, 1)).over(w)).where("_side <> 0")
    near = counted.groupBy(*keys, "cut").agg(F.max(F.when(F.col("_side") < 0, F.col("_n"))).alias("_a"), (F.max(F.when(F.col("_side") > 0, F.col("_n"))) - 1).alias("_b"))
    order = Window.partitionBy(*keys).orderBy("cut")
    half = lambda other: F.floor((F.col("cut") + other) / 2)
    a = F.least(F.col("cut"), F.greatest(F.col("_a"), half(F.lag("cut").over(order))))
    b = F.greatest(F.col("cut"), F.least(F.col("_b"), half(F.lead("cut").over(order))))
    return near.select(*keys, "cut", a.alias("first"), b.alias("last"))

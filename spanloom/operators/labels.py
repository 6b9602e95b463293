"""Label records: contradictions within one, what it lacks, linked issues, ordered choices."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from spanloom.operators.components import components
from spanloom.operators.scans import Kernel, streamed

#: Outcomes that reach the goal or don't, relations to another task, full progress.
REACHED, MISSED, OTHER = ["success", "success_then_undone"], ["failure", "partial", "unclear"], ["different", "unrelated"]
FULL = 1.0 - 1e-9
#: Share of a part that makes an issue wide, seconds that make two near, words of a lasting condition.
WIDE, NEAR = 0.5, 15.0
LASTING = r"\b(again|still|persist\w*|throughout|entire(ly)?|the whole (take|recording|episode|window|part)|continu\w*|recurr\w*|intermittent\w*|for the rest|all along|once more)\b"


def named(rules: dict[str, Column]) -> Column:
    """The names of the rules that hold, in their order; null counts as not."""
    return F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items())))


def contradictions(outcome: Column, relation: Column, matches: Column, goal: Column, undone: Column, done: Column, duration: Column, last_change: Column, peak: Column, first_full: Column, first_goal: Column, mismatch: Column) -> Column:
    """Names of the rules by which the fields of a record contradict each other."""
    reached, success, turned = outcome.isin(REACHED), outcome == "success", outcome == "success_then_undone"
    no_order = goal.isNull() | undone.isNull() | (undone <= goal)
    times = (goal, undone, done)
    return named({
        "outcome_vs_alignment": reached & relation.isin(OTHER),
        "outcome_vs_partial": reached & (relation == "broader"),
        "alignment_vs_match": (relation == "aligned") & ~matches,
        "undone_timing": turned & no_order,
        "nothing_after_goal": turned & ~no_order & ~F.coalesce(last_change > goal, F.lit(False)),
        "progress_vs_outcome": outcome.isin(MISSED) & (peak >= FULL),
        "goal_times_differ": success & (F.abs(goal - done) > 0.5),
        "progress_before_goal": success & done.isNotNull() & (first_full < F.coalesce(first_goal, done) - 3.0),
        "progress_past_goal": success & (first_full > done + 3.0) & ~(first_full < F.coalesce(first_goal, done) - 3.0) & (relation == "aligned") & ~F.coalesce(mismatch, F.lit(False)),
        "time_past_end": F.greatest(*(F.coalesce(t, F.lit(0.0)) for t in times)) > duration + 1.0,
        "time_before_start": F.least(*(F.coalesce(t, F.lit(0.0)) for t in times)) < 0,
    })


def task_contradictions(outcome: Column, against: Column, relation: Column, goal: Column, undone: Column) -> Column:
    """The same for one task of a record that holds several."""
    return named({
        "task_outcome_vs_alignment": outcome.isin(REACHED) & relation.isin(OTHER) & against.isin("instruction", "subtask"),
        "task_undone_timing": (outcome == "success_then_undone") & (goal.isNull() | undone.isNull() | (undone <= goal)),
    })


def condition(t: Column, end: Column, part_seconds: Column, words: Column) -> Column:
    """Why an issue reads as a condition and not as one event: untimed, wide, wording, or null."""
    return F.when(t.isNull() | end.isNull(), "untimed").when((part_seconds > 0) & (end - t >= WIDE * part_seconds), "wide").when(F.lower(words).rlike(LASTING), "wording")


class Meeting(Kernel):
    """Issues of one key by their starts: each is tied to one member of every group it meets.

    A group is alone while what is left of it is of one part; an issue meets all groups in
    which another part goes on.  Groups that it meets are one from then on, so every
    issue is tied, looked at and let go once.
    """

    def __init__(self, near: float):
        self.near, self.mixed, self.alone, self.held = near, [], {}, 0

    def add(self, ident, part, start, end):
        pairs = []
        for i, p, s, e in zip(ident.tolist(), part.tolist(), start.tolist(), end.tolist()):
            met, due = [], s - self.near
            for g in self.mixed:  # (ident, latest end, its part, latest end of another part, that part)
                if g[3] >= due:
                    met.append(g)
                elif g[1] >= due:
                    self.alone.setdefault(g[2], []).append((*g[:3], float("-inf"), None))
            for q in [q for q in self.alone if q != p]:
                met += [g for g in self.alone.pop(q) if g[1] >= due]
            pairs += [(i, g[0]) for g in met]
            ends = {p: e}
            for g in met:
                for end_, q in ((g[1], g[2]), (g[3], g[4])):
                    if q is not None:
                        ends[q] = max(end_, ends.get(q, end_))
            top = sorted(((v, q) for q, v in ends.items()), reverse=True)[:2]
            self.mixed = [(i, *top[0], *top[1])] if len(top) > 1 else []
            if len(top) == 1:
                own = self.alone.setdefault(p, [])
                own.append((i, e, p, float("-inf"), None))
                if len(own) > 2 * self.held + 1000:
                    own[:] = [g for g in own if g[1] >= due]
                    self.held = len(own)
        return tuple(np.array(c) for c in zip(*pairs)) if pairs else None


def linked_issues(issues: DataFrame, keys: list[str], ident: str, part: str, start: str, end: str, signal: str, near: float = NEAR) -> DataFrame:
    """ident and group (the smallest ident of it) of issues of one key: those with a
    condition ``signal`` are one group, and two of different parts are linked where their
    spans lie within ``near`` of each other.

    The signalled ones are tied to the first of their key.  The others stream by their
    starts and are tied to one member of each group that they meet (see ``Meeting``), so
    there are about as many ties as issues however many lie near each other.  Idents
    are longs, unique in the table.
    """
    first = issues.where(F.col(signal).isNotNull()).groupBy(*keys).agg(F.min(ident).alias("b"))
    tied = issues.where(F.col(signal).isNotNull()).join(first, keys).select(F.col(ident).alias("a"), "b")
    hi = F.greatest(F.col(start), F.coalesce(F.col(end), F.col(start))).cast("double")
    timed = issues.where(F.col(start).isNotNull() & F.col(part).isNotNull())
    columns = {"i": F.col(ident).cast("long"), "p": F.xxhash64(part), "s": F.col(start).cast("double"), "e": hi}
    close = streamed(timed, keys, [start, ident], columns, lambda: Meeting(near), "a bigint, b bigint").select("a", "b")
    of = components(tied.unionByName(close))
    return issues.join(of, F.col(ident) == F.col("node"), "left").select(F.col(ident), F.coalesce("component", F.col(ident)).alias("group"))


def grouped_issues(issues: DataFrame, groups: DataFrame, ident: str, part: str, start: str, end: str, severity: str, text: str) -> DataFrame:
    """One row a group: n, its parts, first start, last end, highest severity, its texts in time order."""
    rank = F.when(F.col(severity) == "high", 3).when(F.col(severity) == "medium", 2).when(F.col(severity) == "low", 1).otherwise(0)
    line = F.struct(F.col(start).isNull().alias("late"), F.col(start).alias("s"), F.col(end).alias("e"), F.col(ident).alias("i"), F.col(text).alias("x"))
    g = issues.join(groups, ident).groupBy("group").agg(
        F.count("*").alias("n"), F.array_sort(F.collect_set(part)).alias("parts"), F.min(start).alias("s"), F.max(F.when(F.col(start).isNotNull(), F.greatest(start, F.coalesce(end, start)))).alias("e"),
        F.max_by(severity, rank).alias("severity"), F.array_sort(F.collect_list(line)).alias("_lines"),
    )
    return g.withColumn("texts", F.transform("_lines", lambda r: r["x"])).drop("_lines")


def same_rows(before: DataFrame, after: DataFrame) -> bool:
    """Whether two tables hold the same rows as often."""
    return before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()


def chronological(items: Column, start: str, end: str) -> Column:
    """An array of structs in time order: by start, then end, rows without either last."""
    key = lambda r, c: F.coalesce(r[c], F.lit(float("inf")))
    compare = lambda a, b, c: F.when(key(a, c) < key(b, c), -1).when(key(a, c) > key(b, c), 1)
    return F.array_sort(items, lambda a, b: F.coalesce(compare(a, b, start), compare(a, b, end), F.lit(0)))


def interleaved(df: DataFrame, kind: str, order: list[str]) -> DataFrame:
    """``df`` with place: kinds in turn, each kind's rows in ``order`` (rows of the i-th turn
    come before those of the next)."""
    turn = F.row_number().over(Window.partitionBy(kind).orderBy(*order))
    d = df.withColumn("turn", turn)
    return d.withColumn("place", F.row_number().over(Window.partitionBy("turn").orderBy(kind, *order)))


def page(df: DataFrame, group: list[str], order: list[str], size: str, budget: int) -> DataFrame:
    """The rows of each group, in order, whose sizes up to and with them fit ``budget``; the first always."""
    w = Window.partitionBy(*group).orderBy(*order)
    d = df.withColumns({"used": F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0)), "_k": F.row_number().over(w)})
    return d.where((F.col("used") <= budget) | (F.col("_k") == 1)).drop("_k")


def outline(df: DataFrame, keys: list[str], order: str, values: list[str], most: int) -> DataFrame:
    """At most ``most`` rows of each key with why: its ends, each value's extrema, their
    neighbours, then rows spread evenly over the rest."""
    w, whole = Window.partitionBy(*keys).orderBy(order), Window.partitionBy(*keys)
    d = df.withColumns({"_k": F.row_number().over(w), "_n": F.count("*").over(whole)})
    for j, v in enumerate(values):
        d = d.withColumns({f"_lo{j}": F.min(F.struct(v, order)).over(whole)[order] == F.col(order), f"_hi{j}": F.min(F.struct((-F.col(v)).alias("v"), order)).over(whole)[order] == F.col(order)})
    peak = F.greatest(*(F.col(f"_{s}{j}") for j in range(len(values)) for s in ("lo", "hi"))) if values else F.lit(False)
    d = d.withColumn("_peak", peak)
    beside = F.coalesce(F.lag("_peak").over(w), F.lit(False)) | F.coalesce(F.lead("_peak").over(w), F.lit(False))
    evenly = F.floor((F.col("_k") - 1) * most / F.col("_n")) != F.floor((F.col("_k") - 2) * most / F.col("_n"))
    rank = F.when(F.col("_k").isin(1) | (F.col("_k") == F.col("_n")), 0).when(F.col("_peak"), 1).when(beside, 2).when(evenly, 3).otherwise(4)
    d = d.withColumn("_rank", rank)
    d = d.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy("_rank", order))).where(F.col("_place") <= most)
    why = F.element_at(F.array(*map(F.lit, ["end", "peak", "neighbour", "spread", "rest"])), F.col("_rank") + 1)
    return d.withColumn("why", why).select(*df.columns, "why")


def one_case(texts: Column) -> Column:
    """Texts with one case of their first letters, that of most of their first words (lower on a
    tie).  Only ordinary words count and change: letters in lower case after the first, so
    "UMI" and "X3" stay, and a single capital does too."""
    rest = r"($|[^\p{L}\p{N}_])"
    upper, lower = (lambda t: t.rlike("^[A-Z][a-z]+" + rest)), (lambda t: t.rlike("^[a-z]+" + rest))
    more = F.size(F.filter(texts, upper)) > F.size(F.filter(texts, lower))
    tail = lambda t: F.substring(t, F.lit(2), F.length(t))
    first = lambda t: F.substring(t, 1, 1)
    return F.transform(texts, lambda t: F.when(more & lower(t), F.concat(F.upper(first(t)), tail(t))).when(~more & upper(t), F.concat(F.lower(first(t)), tail(t))).otherwise(t))

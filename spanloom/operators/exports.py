"""Timed labels written onto frames: each on the nearest one, or refused; what must hold after."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from spanloom.operators import asof

EPS = 1e-6


def snapped(items: DataFrame, frames: DataFrame, keys: list[str], t: str, ts: str, period: float) -> DataFrame:
    """``items`` with at (the nearest frame's time, the earlier on a tie), off (seconds from it) and
    fate: "placed", "far" (further than ``period`` from any frame but between the first
    and the last), "refused" (further than that outside of them, or a key without frames: at is
    null), or "untimed".  frames: a row a frame with its time ``ts``."""
    own = frames.select(*keys, F.col(ts).cast("double").alias(t)).withColumn("_at", F.col(t))
    d = asof.nearest(items.withColumn(t, F.col(t).cast("double")), own, keys, t, "_at", ["_at"])
    ends = frames.groupBy(*keys).agg(F.min(F.col(ts).cast("double")).alias("_lo"), F.max(F.col(ts).cast("double")).alias("_hi"))
    d = d.join(ends, keys, "left").withColumns({"_m": F.col("m._at")}).withColumn("off", F.abs(F.col(t) - F.col("_m")))
    inside = (F.col(t) >= F.col("_lo")) & (F.col(t) <= F.col("_hi"))
    fate = F.when(F.col(t).isNull(), "untimed").when(F.col("_m").isNull(), "refused").when(F.col("off") <= period + EPS, "placed").when(inside, "far").otherwise("refused")
    d = d.withColumn("fate", fate)
    kept = F.col("fate").isin("placed", "far")
    return d.withColumns({"at": F.when(kept, F.col("_m")), "off": F.when(F.col("fate") != "untimed", F.col("off"))}).drop("m", "_m", "_lo", "_hi")


def persistent_rows(placed: DataFrame, frames: DataFrame, keys: list[str], t: str, text: str, ts: str) -> DataFrame:
    """keys, at and ``text``: what is in force from each frame on.  Of two on one frame the later
    (by ``t``) counts; one that repeats the text in force is no new row; the first is in force from the
    first frame on."""
    d = placed.where(F.col("at").isNotNull()).groupBy(*keys, "at").agg(F.max_by(text, F.struct(t, text)).alias(text))
    w = Window.partitionBy(*keys).orderBy("at")
    d = d.withColumns({"_was": F.lag(text).over(w), "_k": F.row_number().over(w)}).where((F.col("_k") == 1) | ~F.col("_was").eqNullSafe(F.col(text)))
    first = frames.groupBy(*keys).agg(F.min(F.col(ts).cast("double")).alias("_lo"))
    return d.join(first, keys).select(*keys, F.when(F.col("_k") == 1, F.col("_lo")).otherwise(F.col("at")).alias("at"), text)


def lost_texts(placed: DataFrame, keys: list[str], t: str, text: str, names: str) -> DataFrame:
    """keys, ``t``, ``text`` and replaced_by of items that another on the same frame has replaced and
    of whose ``names`` (an array) one is in no item that was kept."""
    w = Window.partitionBy(*keys, "at").orderBy(F.col(t).desc(), F.col(text).desc())
    d = placed.where(F.col("at").isNotNull()).withColumns({"_k": F.row_number().over(w), "_by": F.first(text).over(w)})
    kept = d.where("_k = 1").select(*keys, F.explode(names).alias("_n")).distinct()
    gone = d.where((F.col("_k") > 1) & (F.col("_by") != F.col(text)))
    missing = gone.select(*keys, t, text, "_by", F.explode(names).alias("_n")).join(kept, [*keys, "_n"], "left_anti")
    return missing.select(*keys, t, text, F.col("_by").alias("replaced_by")).distinct()


def broken(frames: DataFrame, persistent: DataFrame, events: DataFrame, keys: list[str], ts: str, styles: dict[str, list[str]]) -> DataFrame:
    """rule and broken: how many rows (or keys) of a written set break each rule.

    frames: keys, ``ts``; persistent: keys, at, style, content, camera; events: keys, at, style,
    content, calls, camera.  styles: "persistent", "events" and "views", those that carry a camera.
    """
    view = lambda d: F.col("camera").isNotNull() != F.col("style").isin(styles["views"])
    on = frames.select(*keys, F.col(ts).cast("double").alias("at")).distinct()
    starts = persistent.groupBy(*keys).agg(F.min("at").alias("first"), F.count("*").alias("n"), F.countDistinct("at").alias("different"))
    begin = on.groupBy(*keys).agg(F.min("at").alias("begin"))
    counted = lambda d, rule: d.agg(F.count("*").alias("broken")).select(F.lit(rule).alias("rule"), "broken")
    rules = {
        "a persistent style in its place": persistent.where(~F.col("style").isin(styles["persistent"])),
        "an event style in its place": events.where(~F.col("style").isin(styles["events"])),
        "a camera where the view decides": persistent.where(view(persistent)).select("style").unionByName(events.where(view(events)).select("style")),
        "content or calls": events.where("content is null and calls is null"),
        "an event on one frame": events.groupBy(*keys, "style", "content", "calls").agg(F.countDistinct("at").alias("n")).where("n > 1"),
        "an event on a frame": events.join(on, [*keys, "at"], "left_anti"),
        "a first row on the first frame": starts.join(begin, keys).where("first <> begin"),
        "starts are distinct": starts.where("different < n"),
        "starts are frames": persistent.join(on, [*keys, "at"], "left_anti"),
        "frames for every key": starts.join(begin, keys, "left_anti"),
    }
    out = None
    for rule, d in rules.items():
        one = counted(d, rule)
        out = one if out is None else out.unionByName(one)
    return out


def verified_groups(issues: DataFrame, proposed: DataFrame, ident: str, category: str, severity: str, start: str, end: str) -> tuple[DataFrame, DataFrame]:
    """(group, idents, category, severity, start, end and sentence of every issue or group after
    grouping; group and why of the proposals that were not taken).

    proposed: group, ``ident`` and sentence, a row for each member.  A group is taken if it has two
    members or more, all of them issues of one category, none named twice or by
    another group, and a sentence; else its issues stay as they came.  Every issue is in
    the first table exactly once, alone or as a member; a group has its members' highest
    severity and their span.
    """
    rank = F.when(F.col(severity) == "high", 3).when(F.col(severity) == "medium", 2).when(F.col(severity) == "low", 1).otherwise(0)
    named = proposed.withColumn("_often", F.count("*").over(Window.partitionBy(ident)))
    known = issues.select(ident, F.col(category).alias("_c"), F.lit(True).alias("_known"))
    d = named.join(known, ident, "left")
    g = d.groupBy("group").agg(F.count("*").alias("n"), F.max("_often").alias("often"), F.bool_and(F.coalesce("_known", F.lit(False))).alias("known"), F.min("_c").alias("a"), F.max("_c").alias("z"), F.count("_c").alias("c"), F.max("sentence").alias("sentence"))
    why = F.when(F.col("often") > 1, "an issue is named more than once").when(~F.col("known"), "a member is no issue").when(F.col("n") < 2, "fewer than two members")
    why = why.when((F.col("a") != F.col("z")) | (F.col("c") < F.col("n")), "members of several categories").when(F.coalesce(F.trim("sentence"), F.lit("")) == "", "no sentence")
    judged = g.withColumn("why", why)
    taken = judged.where("why is null").select("group", "sentence")
    member = proposed.select("group", ident).join(taken, "group")
    both = issues.join(member, ident, "left").withColumn("_g", F.coalesce(F.col("group").cast("string"), F.concat(F.lit("\0"), F.col(ident).cast("string"))))
    last = F.max(F.when(F.col(start).isNotNull(), F.greatest(start, F.coalesce(end, start))))
    out = both.groupBy("_g").agg(F.min("group").alias("group"), F.array_sort(F.collect_list(ident)).alias("idents"), F.min(category).alias("category"), F.max_by(severity, rank).alias("severity"), F.min(start).alias("start"), F.when(F.count("*") > 1, last).otherwise(F.max(end)).alias("end"), F.max("sentence").alias("sentence"))
    return out.drop("_g"), judged.where("why is not null").select("group", "why")

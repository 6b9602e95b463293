"""Interval operators over rows (keys..., start, end) with end >= start.

Rows whose end is not after their start, or with a null bound, cover nothing.
Everything is a window or an equi-join within a key, so work spreads by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def merge(df: DataFrame, keys: list[str], start: str = "s", end: str = "e", gap: float = 0.0) -> DataFrame:
    """The union as disjoint spans: intervals that touch, overlap or lie at most
    ``gap`` apart become one, with n, the number of intervals in it."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = df.where(F.col(end) > F.col(start)).select(*keys, start, end)
    opened = rows.withColumn("_new", F.when(F.col(start) <= reach + gap, 0).otherwise(1))
    numbered = opened.withColumn("_span", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_span").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n")).drop("_span")


def clip(df: DataFrame, lo: Column, hi: Column, start: str = "s", end: str = "e") -> DataFrame:
    """Intervals cut to [lo, hi]; those outside go."""
    cut = df.withColumns({start: F.greatest(F.col(start), lo), end: F.least(F.col(end), hi)})
    return cut.where(F.col(end) > F.col(start))


def union_length(df: DataFrame, keys: list[str], start: str = "s", end: str = "e", name: str = "covered") -> DataFrame:
    return merge(df, keys, start, end).groupBy(*keys).agg(F.sum(F.col(end) - F.col(start)).alias(name))


def segments(df: DataFrame, keys: list[str], start: str = "s", end: str = "e") -> DataFrame:
    """The sweep line: elementary segments between all bounds of a key, with
    n_open, how many intervals cover each; empty segments and gaps are left out."""
    rows = df.where(F.col(end) > F.col(start))
    bounds = rows.select(*keys, F.col(start).alias("t"), F.lit(1).alias("d")).unionByName(rows.select(*keys, F.col(end).alias("t"), F.lit(-1).alias("d")))
    steps = bounds.groupBy(*keys, "t").agg(F.sum("d").alias("d"))
    w = Window.partitionBy(*keys).orderBy("t")
    swept = steps.withColumns({"n_open": F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0)), "until": F.lead("t").over(w)})
    return swept.where("n_open > 0 and until is not null").select(*keys, F.col("t").alias(start), F.col("until").alias(end), "n_open")


def difference(df: DataFrame, cut: DataFrame, keys: list[str], start: str = "s", end: str = "e") -> DataFrame:
    """What ``df`` covers and ``cut`` does not, as disjoint spans."""
    a = df.where(F.col(end) > F.col(start)).select(*keys, start, end)
    b = cut.where(F.col(end) > F.col(start)).select(*keys, start, end)

    def bounds(rows: DataFrame, own: str, other: str) -> DataFrame:
        ups = rows.select(*keys, F.col(start).alias("t"), F.lit(1).alias(own))
        downs = rows.select(*keys, F.col(end).alias("t"), F.lit(-1).alias(own))
        return ups.unionByName(downs).withColumn(other, F.lit(0))

    steps = bounds(a, "da", "db").unionByName(bounds(b, "db", "da")).groupBy(*keys, "t").agg(F.sum("da").alias("da"), F.sum("db").alias("db"))
    w = Window.partitionBy(*keys).orderBy("t")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    swept = steps.withColumns({"na": F.sum("da").over(upto), "nb": F.sum("db").over(upto), "until": F.lead("t").over(w)})
    left = swept.where("na > 0 and nb = 0 and until is not null").select(*keys, F.col("t").alias(start), F.col("until").alias(end))
    return merge(left, keys, start, end).drop("n")


def overlaps(left: DataFrame, right: DataFrame, keys: list[str], width: float, start: str = "s", end: str = "e", least: float = 0.0) -> DataFrame:
    """Pairs of rows of one key whose intervals share more than ``least``.

    Both sides are dealt into buckets of ``width`` time units and joined on
    (keys, bucket); a pair counts in the first bucket that both reach, so it
    comes once.  Right-hand columns other than the keys get the suffix _r.
    """
    lo = lambda c: F.floor(F.col(c) / width).cast("long")
    dealt = lambda d: d.where(F.col(end) > F.col(start)).withColumn("_b", F.explode(F.sequence(lo(start), lo(end))))
    two = dealt(right).select(*(F.col(c).alias(c if c in keys or c == "_b" else f"{c}_r") for c in [*right.columns, "_b"]))
    met = dealt(left).join(two, [*keys, "_b"])
    shared = F.least(F.col(end), F.col(f"{end}_r")) - F.greatest(F.col(start), F.col(f"{start}_r"))
    first = F.floor(F.greatest(F.col(start), F.col(f"{start}_r")) / width).cast("long")
    return met.withColumn("shared", shared).where((F.col("shared") > least) & (F.col("_b") == first)).drop("_b")


def best_cover(items: DataFrame, spans: DataFrame, keys: list[str], item_id: str, span_id: str, width: float, share: float = 0.5) -> DataFrame:
    """For each item the span that covers most of it, where that is at least
    ``share`` of it; ties to the smaller span id."""
    pairs = overlaps(items, spans, keys, width)
    best = pairs.groupBy(*keys, item_id, "s", "e").agg(F.min(F.struct((-F.col("shared")).alias("m"), F.col(f"{span_id}_r").alias("id"))).alias("b"))
    return best.where(-F.col("b.m") >= share * (F.col("e") - F.col("s"))).select(*keys, item_id, F.col("b.id").alias(span_id), (-F.col("b.m")).alias("covered"))

"""As-of and nearest joins, and linear placement, by one union and one window per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def beside(left: DataFrame, right: DataFrame, keys: list[str], t: str, tie: str, values: list[str]) -> DataFrame:
    """Left rows with the last right row at or before them (prev: t and values)
    and the first at or after (next).  Of right rows with one time, the one with
    the smallest ``tie`` counts."""
    one = right.groupBy(*keys, t).agg(F.min(F.struct(tie, *[v for v in values if v != tie])).alias("_r"))
    item = F.struct(F.col(t).alias("t"), *(F.col(f"_r.{v}").alias(v) for v in values))
    marks = one.select(*keys, t, item.alias("_v"), F.lit(0).alias("_side"))
    rows = left.withColumns({"_v": F.lit(None).cast(marks.schema["_v"].dataType), "_side": F.lit(1)})
    both = rows.unionByName(marks, allowMissingColumns=True)
    back = Window.partitionBy(*keys).orderBy(t, "_side").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys).orderBy(F.desc(t), "_side").rowsBetween(Window.unboundedPreceding, 0)
    placed = both.withColumns({"prev": F.last("_v", ignorenulls=True).over(back), "next": F.last("_v", ignorenulls=True).over(ahead)})
    return placed.where("_side = 1").drop("_side", "_v")


def backward(left: DataFrame, right: DataFrame, keys: list[str], t: str, tie: str, values: list[str], tolerance: float | None = None) -> DataFrame:
    """The last right row at or before each left row, within ``tolerance``; m is
    the match (t and values) or null."""
    d = beside(left, right, keys, t, tie, values)
    near = F.lit(True) if tolerance is None else F.col(t) - F.col("prev.t") <= tolerance
    return d.withColumn("m", F.when(near, F.col("prev"))).drop("prev", "next")


def nearest(left: DataFrame, right: DataFrame, keys: list[str], t: str, tie: str, values: list[str], tolerance: float | None = None) -> DataFrame:
    """The right row nearest in time, the earlier one on a tie, within ``tolerance``."""
    d = beside(left, right, keys, t, tie, values)
    a, b = F.col(t) - F.col("prev.t"), F.col("next.t") - F.col(t)
    pick = F.when(F.col("prev").isNull(), F.col("next")).when(F.col("next").isNull() | (a <= b), F.col("prev")).otherwise(F.col("next"))
    d = d.withColumn("m", pick)
    near = F.lit(True) if tolerance is None else F.abs(F.col("m.t") - F.col(t)) <= tolerance
    return d.withColumn("m", F.when(near, F.col("m"))).drop("prev", "next")


def linear(left: DataFrame, right: DataFrame, keys: list[str], t: str, tie: str, value: str, most: float) -> DataFrame:
    """``value`` placed on left times between the right rows around them; null
    outside, or where those are more than ``most`` apart."""
    d = beside(left, right, keys, t, tie, [value])
    width = F.col("next.t") - F.col("prev.t")
    at = F.col(f"prev.{value}") + (F.col(f"next.{value}") - F.col(f"prev.{value}")) * (F.col(t) - F.col("prev.t")) / width
    placed = F.when(width == 0, F.col(f"prev.{value}")).when(width <= most, at)
    return d.withColumn("placed", placed).drop("prev", "next")

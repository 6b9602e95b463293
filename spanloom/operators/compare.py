"""Comparisons of runs over the same items: agreement, common means, bootstrap."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F


def common(df: DataFrame, who: str, item: str) -> DataFrame:
    """Rows of the items that every ``who`` has."""
    everyone = df.agg(F.countDistinct(who).alias("_all"))
    full = df.groupBy(item).agg(F.countDistinct(who).alias("_n"))
    n = everyone.first()["_all"]
    return df.join(full.where(F.col("_n") == n).select(item), item, "left_semi")


def agreement(df: DataFrame, who: str, item: str, value: str) -> DataFrame:
    """For each pair of ``who``: items both have, and how often the values agree.

    Per item the values are gathered per ``who`` (few), so the pairs are of
    ``who`` values, never of rows."""
    a, b = df.select(F.col(who).alias("a"), item, F.col(value).alias("va")), df.select(F.col(who).alias("b"), item, F.col(value).alias("vb"))
    both = a.join(b, item).where("a < b")
    return both.groupBy("a", "b").agg(F.count("*").alias("n"), F.count_if(F.col("va").eqNullSafe(F.col("vb"))).alias("same")).withColumn("share", F.col("same") / F.col("n"))


def micro_jaccard(df: DataFrame, item: str, left: str, right: str) -> DataFrame:
    """One row: sum of intersections over sum of unions of two array columns."""
    i = F.size(F.array_intersect(left, right))
    u = F.size(F.array_union(left, right))
    return df.agg(F.count(item).alias("items"), F.sum(i).alias("shared"), F.sum(u).alias("all"), (F.sum(i) / F.sum(u)).alias("jaccard"))


def uniform(*parts: Column) -> Column:
    """A number from 0 to 1 (exclusive) of the parts' values: the first 32 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws("-", *(p.cast("string") for p in parts))), 1, 8), 16, 10).cast("double") / float(1 << 32)


def poisson_cuts() -> list[float]:
    """P(count <= k) of a Poisson(1) count for k from 0 to 7; more is a chance of 1e-5."""
    out, total, term = [], 0.0, math.exp(-1)
    for k in range(8):
        total += term
        out.append(total)
        term /= k + 1
    return out


def paired_bootstrap(pairs: DataFrame, item: str, before: str, after: str, draws: int = 1000, seed: int = 1, level: float = 0.95) -> DataFrame:
    """difference, low, high and verdict (gain, drop, same) of mean(after) - mean(before).

    Each draw weights items by Poisson(1) counts from a hash of (seed, draw,
    item), the usual form of the bootstrap for data that is spread over
    machines: no row ever has to meet another, and sums per draw are partial.
    The interval takes sorted draws at whole positions.
    """
    rows = pairs.where(F.col(before).isNotNull() & F.col(after).isNotNull()).withColumn("_d", F.col(after) - F.col(before))
    some = rows.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))))
    u = uniform(F.lit(seed), F.col("draw"), F.col(item))
    weight = sum(((u >= c).cast("int") for c in poisson_cuts()), F.lit(0))
    sums = some.withColumn("_w", weight).groupBy("draw").agg(F.sum("_w").alias("w"), F.sum(F.col("_w") * F.col("_d")).alias("s")).where("w > 0")
    means = sums.agg(F.sort_array(F.collect_list(F.col("s") / F.col("w"))).alias("m"))
    side = (1 - level) / 2
    place = lambda q: F.greatest(F.lit(1), F.least(F.size("m"), F.floor(F.size("m") * q).cast("int") + 1))
    whole = rows.agg(F.avg("_d").alias("difference"), F.count("*").alias("items"))
    bounds = means.select(F.element_at("m", place(side)).alias("low"), F.element_at("m", place(1 - side)).alias("high"))
    out = whole.withColumn("_1", F.lit(1)).join(bounds.withColumn("_1", F.lit(1)), "_1").drop("_1")
    return out.withColumn("verdict", F.when(F.col("low") > 0, "gain").when(F.col("high") < 0, "drop").otherwise("same"))

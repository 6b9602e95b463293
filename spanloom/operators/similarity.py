"""Exact set similarity by prefix filtering, and name grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from spanloom.operators.components import components
from spanloom.session import stored

#: Words of 64 bits of a set's sketch.
SKETCH = 8


def candidates(groups: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of ``groups`` (g, n and t: n tokens) that the bounds of ``set_pairs`` leave."""
    long = groups.select("g", "n", F.explode("t").alias("w"))
    rare = long.groupBy("w").agg(F.count("*").alias("f"))
    rank = Window.partitionBy("g").orderBy("f", "w")
    prefix = long.join(rare, "w").withColumn("r", F.row_number().over(rank)).where(F.col("r") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
    place = F.pmod(F.xxhash64("w"), F.lit(64 * SKETCH))
    bits = [F.bit_xor(F.when(F.floor(place / 64) == k, F.expr("shiftleft(1L, CAST(pmod(xxhash64(w), 64) AS INT))")).otherwise(F.lit(0).cast("long"))).alias(f"s{k}") for k in range(SKETCH)]
    prefix = prefix.select("g", "n", "w", "r").join(long.groupBy("g").agg(*bits), "g")
    side = lambda x: prefix.select(F.col("g").alias(x), F.col("n").alias("n" + x), "w", F.col("r").alias("r" + x), *(F.col(f"s{k}").alias(f"{x}{k}") for k in range(SKETCH)))
    least = F.ceil((F.col("na") + F.col("nb")) * (threshold / (1 + threshold)) - 1e-9)
    rest = 1 + F.least(F.col("na") - F.col("ra"), F.col("nb") - F.col("rb"))
    apart = sum((F.bit_count(F.col(f"a{k}").bitwiseXOR(F.col(f"b{k}"))) for k in range(SKETCH)), F.lit(0))
    alike = (F.least("na", "nb") >= F.greatest("na", "nb") * threshold - 1e-9) & (rest >= least) & (apart <= F.col("na") + F.col("nb") - 2 * least)
    return side("a").join(side("b").hint("merge"), "w").where((F.col("a") < F.col("b")) & alike).select("a", "b").distinct()


def set_pairs(df: DataFrame, item: str, tokens: str, threshold: float) -> DataFrame:
    """Pairs (a, b, jaccard) of items with different token sets at least
    ``threshold`` alike, a < b; of items with one set the smallest stands for all.

    Only the rarest n - ceil(threshold * n) + 1 tokens of a set can be the first
    that two such sets share, so only those are joined, with the length filter
    in the join; the full sets confirm.  Equal sets are grouped first; a join on
    the set itself gives their other items.  Empty sets match nothing.

    Where two sets meet first, they can share no more than what follows there in the
    shorter rest.  And each set has a sketch, one bit toggled for each token: two sketches
    differ in no more bits than the sets differ in tokens.  Both bounds are asked in the
    join, so hardly any pair leaves it that is not alike, and no pair that is is lost.
    """
    sets = df.select(F.col(item).alias("id"), F.array_sort(F.array_distinct(tokens)).alias("t")).where(F.size("t") > 0)
    groups = stored(sets.groupBy("t").agg(F.min("id").alias("g")).withColumn("n", F.size("t")), "sets")
    met = candidates(groups, threshold)
    full = met.join(groups.select(F.col("g").alias("a"), F.col("t").alias("ta")), "a").join(groups.select(F.col("g").alias("b"), F.col("t").alias("tb")), "b")
    i = F.size(F.array_intersect("ta", "tb"))
    return full.withColumn("jaccard", i / (F.size("ta") + F.size("tb") - i)).where(F.col("jaccard") >= threshold - 1e-12).select("a", "b", "jaccard")


def set_groups(df: DataFrame, item: str, tokens: str, threshold: float) -> DataFrame:
    """item and group (its smallest item) of connected similar sets; every row of
    ``df`` comes back, alone where nothing is like it."""
    sets = df.select(F.col(item).alias("id"), F.array_sort(F.array_distinct(tokens)).alias("t"))
    own = sets.where(F.size("t") > 0).groupBy("t").agg(F.min("id").alias("g"))
    if threshold >= 1:  # equal sets only
        return sets.join(own, "t", "left").select(F.col("id").alias(item), F.coalesce("g", "id").alias("group"))
    of = components(set_pairs(df, item, tokens, threshold).select("a", "b"))
    named = sets.join(own, "t", "left").join(of, F.col("g") == F.col("node"), "left")
    return named.select(F.col("id").alias(item), F.coalesce("component", "g", "id").alias("group"))


def like_names(names: DataFrame, name: str, used: str, grams: str, words: str, k: int = 8) -> DataFrame:
    """For each name its k most alike names (Jaccard of trigram sets) among more
    used ones that share a word; ties to the more used, then by name."""
    # Pairs are found by words and use alone; the trigrams of each side join them afterwards.
    one = names.select(F.col(name).alias("a"), F.col(used).alias("ua"), F.explode(words).alias("w"))
    two = names.select(F.col(name).alias("b"), F.col(used).alias("ub"), F.explode(words).alias("w"))
    pairs = one.join(two, "w").where("ub > ua and a <> b").select("a", "b", "ub").distinct()
    met = pairs.join(names.select(F.col(name).alias("a"), F.col(grams).alias("ga")), "a").join(names.select(F.col(name).alias("b"), F.col(grams).alias("gb")), "b")
    i = F.size(F.array_intersect("ga", "gb"))
    scored = met.withColumn("jaccard", i / (F.size("ga") + F.size("gb") - i))
    rank = Window.partitionBy("a").orderBy(F.desc("jaccard"), F.desc("ub"), "b")
    return scored.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("a", "b", "jaccard", "rank")


def canonical(names: DataFrame, bag: str, name: str, used: str) -> DataFrame:
    """Names of one word bag share the most used of them (ties by name)."""
    best = names.groupBy(bag).agg(F.min(F.struct((-F.col(used)).alias("u"), F.col(name).alias("n"))).alias("_b"))
    return names.join(best.select(bag, F.col("_b.n").alias("canonical")), bag)


def merge_allowed(a: str, b: str):
    """No merge where one word set strictly contains the other."""
    i = F.size(F.array_intersect(a, b))
    return ~((F.size(a) != F.size(b)) & (i == F.least(F.size(a), F.size(b))))

"""Connected components by alternating large and small stars, in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spanloom.session import stored


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step.  edges: u > v.  Neighbours are tied to their smallest one:
    the greater ones by the large star, the smaller ones by the small star."""
    sides = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select("u", "v")
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if large:
        tied = sides.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        tied = sides.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return tied.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component (the smallest node of it) for every node on an edge.

    edges: long columns a and b in any order, repeats and loops allowed.  Each
    round is a written table, so lineage stays short and lost executors cost a
    round at most.  Components of a path of n nodes need about log n rounds.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = lambda d: tuple(d.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = mark(e)
    for _ in range(most_rounds):
        e = stored(star(star(e, True), False), "edges")
        now = mark(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()

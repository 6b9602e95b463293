"""Streams with clocks of their own set against the frames of one of them, the anchor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from spanloom.operators import asof
from spanloom.operators.signals import reading


def onto_anchor(anchor: DataFrame, own: DataFrame, keys: list[str], frame: str, shown: str, step: str, value: str) -> DataFrame:
    """keys, ``frame`` and change of every step of the anchor, from a frame to its next: the sum of
    a stream's own steps between the frames that it shows there.

    anchor: a row a frame with ``shown``, the stream's frame at it; own: a row for each of the
    stream's steps (from 0, none left out) with ``value``.  change is null where the
    stream shows no later frame or one of its steps has no reading; frames past its end
    count as its last.  Sums come from running sums, so a step is read once however
    many anchor steps hold it.
    """
    w = Window.partitionBy(*keys).orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    x = reading(F.col(value))
    run = own.select(*keys, F.col(step).alias("_j"), F.sum(F.coalesce(x, F.lit(0.0))).over(w).alias("_c"), F.sum(x.isNull().cast("int")).over(w).alias("_b"))
    last = run.groupBy(*keys).agg(F.max("_j").alias("_last"))
    a = anchor.join(last, keys).select(*keys, frame, F.greatest(F.lit(0), F.least(F.col(shown), F.col("_last") + 1)).alias("_at"))
    met = a.withColumn("_j", F.col("_at") - 1).join(run, [*keys, "_j"], "left")
    met = met.withColumns({"_c": F.coalesce("_c", F.lit(0.0)), "_b": F.coalesce("_b", F.lit(0))})
    then = Window.partitionBy(*keys).orderBy(frame)
    ahead = met.withColumns({f"_n{c}": F.lead(c).over(then) for c in ("_at", "_c", "_b")})
    change = F.when((F.col("_n_at") > F.col("_at")) & (F.col("_n_b") == F.col("_b")), F.col("_n_c") - F.col("_c"))
    return ahead.where("_n_at is not null").select(*keys, frame, change.alias("change"))


def holding_steps(anchor: DataFrame, own: DataFrame, keys: list[str], frame: str, t: str, place: str) -> DataFrame:
    """keys, ``frame``, first and last: for each step of the anchor the steps of a stream's own frames
    that can hold it, from its last frame at or before the step's start to its first at or
    after the step's end; at least one step, clipped to those that there are.

    anchor: ``frame`` and its time ``t``; own: ``place`` (frames from 0) and its time ``t``.
    """
    d = asof.beside(anchor.select(*keys, frame, t), own.select(*keys, t, place), keys, t, place, [place])
    w = Window.partitionBy(*keys).orderBy(frame)
    d = d.select(*keys, frame, F.coalesce(F.col(f"prev.{place}"), F.lit(-1)).alias("_a"), F.lead(F.struct(F.lit(1).alias("here"), F.col(f"next.{place}").alias("p"))).over(w).alias("_z"))
    n = own.groupBy(*keys).agg((F.max(place) - 1).alias("_most"))
    d = d.where("_z is not null").join(n, keys).where("_most >= 0")
    clip = lambda c: F.greatest(F.lit(0), F.least(c, F.col("_most")))
    first = clip(F.col("_a"))
    last = clip(F.coalesce(F.col("_z.p"), F.col("_most") + 1) - 1)
    return d.select(*keys, frame, first.alias("first"), F.greatest(first, last).alias("last"))


def speeds(df: DataFrame, keys: list[str], order: str, t: str, coordinates: list[str]) -> DataFrame:
    """keys, ``order`` and speed of each step of a point, from a row to its next: how far it moves,
    brought to one typical interval, so that a step over missing rows is no leap."""
    w = Window.partitionBy(*keys).orderBy(order)
    d = df.withColumns({f"_x{k}": reading(F.col(c)) for k, c in enumerate(coordinates)}).withColumn("_t", reading(F.col(t)))
    far = F.sqrt(sum(((F.lead(f"_x{k}").over(w) - F.col(f"_x{k}")) ** 2 for k in range(len(coordinates))), F.lit(0.0)))
    d = d.withColumns({"_far": far, "_dt": F.lead("_t").over(w) - F.col("_t"), "_more": F.lead(F.lit(1)).over(w)})
    usual = d.where("_dt > 1e-4").groupBy(*keys).agg(F.percentile("_dt", 0.5).alias("_usual"))
    d = d.where("_more = 1").join(usual, keys, "left").withColumn("_usual", F.coalesce("_usual", F.lit(1.0)))
    return d.select(*keys, order, (F.col("_far") * F.col("_usual") / F.greatest("_dt", "_usual")).alias("speed"))


def crossed(steps: DataFrame, keys: list[str], streams: tuple[str, str], actors: tuple[str, str], least: int = 10) -> DataFrame:
    """keys, four correlations (left_left, right_right, left_right, right_left), crossed and
    not_assessed: whether both streams follow the other actor's speed better than either
    follows its own.

    steps: a row a step with the two streams' changes and the two actors' speeds.  A step
    counts for a pair where both have a reading; with fewer than ``least`` readings of an
    actor nothing is said and not_assessed names it; a correlation that has no
    spread is null, and crossed with it.
    """
    d = steps.withColumns({f"_{k}": reading(F.col(c)) for k, c in enumerate((*streams, *actors))})
    both = lambda a, b: F.when(F.col(b).isNotNull(), F.col(a))
    pair = lambda a, b: F.try_divide(F.covar_pop(both(a, b), both(b, a)), F.stddev_pop(both(a, b)) * F.stddev_pop(both(b, a)))
    names = {"left_left": ("_0", "_2"), "right_right": ("_1", "_3"), "left_right": ("_0", "_3"), "right_left": ("_1", "_2")}
    g = d.groupBy(*keys).agg(*(pair(a, b).alias(n) for n, (a, b) in names.items()), F.count("_2").alias("_nl"), F.count("_3").alias("_nr"))
    few = F.when(F.col("_nl") < least, actors[0]).when(F.col("_nr") < least, actors[1])
    r: dict[str, Column] = {n: F.when(few.isNull() & ~F.isnan(n), F.col(n)) for n in names}
    whole = r["left_left"].isNotNull() & r["right_right"].isNotNull() & r["left_right"].isNotNull() & r["right_left"].isNotNull()
    swapped = F.least(r["left_right"], r["right_left"]) > F.greatest(r["left_left"], r["right_right"])
    return g.select(*keys, *(c.alias(n) for n, c in r.items()), F.when(whole, swapped).alias("crossed"), few.alias("not_assessed"))

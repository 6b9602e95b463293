"""Levels, rest, stillness and clocks of recorded signals (rows of a key in order).

Nulls and non-finite values are no readings.  Everything is a window or a grouping
within a key but ``calm_spans``, a scan that carries state.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from spanloom.functions import numbers
from spanloom.operators.places import quantiles

#: The band of an end as a share of the range, the share of readings
#: that hold a level, the share of rows that are a recording's start or end.
BAND, HOLD, ENDS = 0.1, 0.3, 0.01
#: Fixed values of the sped-up rule: share of faulty steps, seconds of lag.
FAULTY_SHARE, FASTEST_LAG = 0.02, 3.4 / 30


def reading(value: Column) -> Column:
    """The value as a double, null where it is no finite number."""
    x = value.cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def rest(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """keys, lo, mid, hi (1, 50, 99 %), side (-1 low, 0 middle, 1 high) and level, where
    the signal rests.

    A signal that holds no end for HOLD of its readings rests where its median lies.
    Of one that does, its starts and ends decide, unless an end at zero contradicts
    them; then the end where it dwells, or zero if it dwells at neither.
    """
    rows = df.withColumn("_x", reading(F.col(value)))
    q = quantiles(rows, keys, F.col("_x"), {"lo": 0.01, "mid": 0.5, "hi": 0.99}).join(rows.groupBy(*keys).agg(F.count("_x").alias("_n")), keys)
    w, size = Window.partitionBy(*keys).orderBy(*order), F.count("*").over(Window.partitionBy(*keys))
    edge = F.greatest(F.lit(1), F.floor(size * ENDS))
    k = F.row_number().over(w)
    placed = rows.withColumn("_edge", (k <= edge).cast("int") + (k > size - edge).cast("int")).join(q, keys)
    span, x, at_edge = F.col("hi") - F.col("lo"), F.col("_x"), F.col("_edge")
    votes = placed.groupBy(*keys, "lo", "mid", "hi", "_n").agg(
        F.count_if(x <= F.col("lo") + BAND * span).alias("_low"),
        F.count_if(x >= F.col("hi") - BAND * span).alias("_high"),
        F.sum(F.when(x.isNotNull(), at_edge).otherwise(0)).alias("_ends"),
        F.sum(F.when(x <= F.col("lo") + 0.25 * span, at_edge).otherwise(0)).alias("_ends_low"),
        F.sum(F.when(x >= F.col("hi") - 0.25 * span, at_edge).otherwise(0)).alias("_ends_high"),
    )
    low, high, side = F.lit(-1), F.lit(1), lambda a, b: F.when(a, -1).when(b, 1).otherwise(0)
    dwell = side(F.col("mid") - F.col("lo") <= 0.25 * span, F.col("mid") - F.col("lo") >= 0.75 * span)
    zero_low, zero_high = F.abs("lo") <= BAND * span, F.abs("hi") <= BAND * span
    zero = side(zero_low & ~zero_high, zero_high & ~zero_low)
    ends = side((F.col("_ends_low") > F.col("_ends_high")) & (F.col("_ends_low") * 2 >= F.col("_ends")), (F.col("_ends_high") > F.col("_ends_low")) & (F.col("_ends_high") * 2 >= F.col("_ends")))
    named = votes.withColumns({"_dwell": dwell, "_zero": zero, "_by": ends})
    contradicted = (F.col("_by") != 0) & (F.col("_zero") != 0) & (F.col("_zero") != F.col("_by"))
    weighed = F.when(contradicted, F.when(F.col("_dwell") != 0, F.col("_dwell")).otherwise(F.col("_zero"))).when(F.col("_by") != 0, F.col("_by")).when(F.col("_zero") != 0, F.col("_zero")).otherwise(F.col("_dwell"))
    holds = (F.col("_low") >= HOLD * F.col("_n")) | (F.col("_high") >= HOLD * F.col("_n"))
    sided = named.withColumn("side", F.when(~(span > 0), 0).when(holds, weighed).otherwise(F.col("_dwell")))
    level = F.when(F.col("side") == low, F.col("lo")).when(F.col("side") == high, F.col("hi")).otherwise(F.col("mid"))
    return sided.withColumn("level", F.coalesce(level, F.lit(0.0))).select(*keys, "lo", "mid", "hi", "side", "level")


def swing(df: DataFrame, keys: list[str], value: str, levels: DataFrame) -> DataFrame:
    """keys and swing: the 99 % point of the distance from the level of ``levels``."""
    d = df.join(levels.select(*keys, "level"), keys)
    return quantiles(d, keys, F.abs(reading(F.col(value)) - F.col("level")), {"swing": 0.99})


def change_threshold(df: DataFrame, keys: list[str], column: str, order: list[str], value: str) -> DataFrame:
    """keys and threshold: the greater of a tenth of the 99 % point of the columns' ranges
    and the median of the columns' median steps, those that are zero among them."""
    w = Window.partitionBy(*keys, column).orderBy(*order)
    rows = df.withColumn("_x", reading(F.col(value)))
    rows = rows.withColumn("_step", F.abs(F.col("_x") - F.lag("_x").over(w)))
    per = rows.groupBy(*keys, column).agg((F.max("_x") - F.min("_x")).alias("_range"), F.percentile("_step", 0.5).alias("_step"))
    return per.groupBy(*keys).agg(F.greatest(0.1 * F.percentile("_range", 0.99), F.percentile("_step", 0.5)).alias("threshold"))


class Calm:
    """The scan behind ``calm_spans``: rows of one key in order, at most ``need`` of them held."""

    def __init__(self, limit: np.ndarray, need: int, complete: bool):
        self.limit, self.need, self.complete = limit, need, complete
        self.before, self.out = None, []
        self.clear()

    def clear(self) -> list:
        held, self.held, self.n = getattr(self, "held", []), [], 0
        return held

    def close(self) -> list:
        """End the span; what a too short one held but its first row comes again."""
        if self.n >= self.need:
            self.out.append((self.first, self.first + self.n - 1))
            self.clear()
            return []
        return self.clear()[1:]

    def add(self, at: int, x: np.ndarray) -> None:
        if self.complete and np.isnan(x).any():
            self.end()
            return
        calm = self.before is None or not (np.abs(x - self.before) > self.limit).any()
        self.before, todo = x, [(at, x, calm)]
        while todo:
            row = todo.pop(0)
            if not self.n:
                if row[2]:  # a span doesn't begin with a jump
                    self.first, self.lo, self.hi, self.held, self.n = row[0], row[1], row[1], [row], 1
                continue
            lo, hi = np.fmin(self.lo, row[1]), np.fmax(self.hi, row[1])
            if (hi - lo > self.limit).any():
                todo = [*self.close(), row, *todo]
                continue
            self.lo, self.hi, self.n = lo, hi, self.n + 1
            if self.n <= self.need:
                self.held.append(row)

    def end(self) -> None:
        if self.n >= self.need:
            self.close()
        self.clear()
        self.before = None


def calm_spans(df: DataFrame, keys: list[str], order: list[str], values: list[str], tolerance: list[float], need: int, complete: bool = False) -> DataFrame:
    """keys, first, last (row numbers from 0) and n of spans of at least ``need`` rows in
    which each value's range stays within its tolerance.

    From left to right a span takes all rows that it can; a start that reaches too few
    gives way to the next row, and none begins right after a jump.  A row without a
    reading is passed over for that value, or with ``complete`` ends the span.  Rows
    stream through a task in order, at most ``need`` of them are held.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    rows = df.select(*keys, (F.row_number().over(w) - 1).cast("long").alias("_k"), *(reading(F.col(v)).alias(f"_v{j}") for j, v in enumerate(values)))
    limit, n_keys = np.array(tolerance) + 1e-12, len(keys)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:n_keys]), "first long, last long, n long"])

    def scan(batches):
        held, calm, kinds = None, None, None

        def done():
            calm.end()
            found = pa.RecordBatch.from_arrays([*(pa.array([k] * len(calm.out), t) for k, t in zip(held, kinds)), *(pa.array(c, pa.int64()) for c in ([a for a, _ in calm.out], [b for _, b in calm.out], [b - a + 1 for a, b in calm.out]))], [*keys, "first", "last", "n"])
            calm.out.clear()
            return found

        for b in batches:
            kinds = [b.schema.field(j).type for j in range(n_keys)]
            x = np.stack([b.column(n_keys + 1 + j).to_numpy(zero_copy_only=False).astype(float) for j in range(len(values))], 1)
            for key, at, row in zip(zip(*(b.column(j).to_pylist() for j in range(n_keys))), b.column(n_keys).to_pylist(), x):
                if key != held:
                    if calm:
                        yield done()
                    held, calm = key, Calm(limit, need, complete)
                calm.add(at, row)
        if calm:
            yield done()

    return rows.repartition(*keys).sortWithinPartitions(*keys, "_k").mapInArrow(scan, schema)


def peak_lag(correlations: DataFrame, keys: list[str], lag: str = "lag", r: str = "r") -> DataFrame:
    """keys and peak: the lag of the greatest correlation (the smallest on a tie), moved to
    the top of the parabola through it and its neighbours where it has both."""
    w = Window.partitionBy(*keys).orderBy(lag)
    d = correlations.where(F.col(r).isNotNull()).withColumns({"_a": F.lag(r).over(w), "_b": F.lead(r).over(w)})
    top = d.groupBy(*keys).agg(F.max_by(F.struct(lag, r, "_a", "_b"), F.struct(r, -F.col(lag))).alias("_t"))
    bend = F.col("_t._a") - 2 * F.col(f"_t.{r}") + F.col("_t._b")
    moved = F.col(f"_t.{lag}") + F.when(bend != 0, 0.5 * (F.col("_t._a") - F.col("_t._b")) / bend).otherwise(0.0)
    return top.select(*keys, F.coalesce(moved, F.col(f"_t.{lag}").cast("double")).alias("peak"))


def sped_up(lag_s: Column, skipped: Column, repeated: Column, neighbours_s: Column) -> Column:
    """Whether a recording was sped up: many faulty steps and short lags, its own and its
    neighbours'.  False where anything is missing."""
    return F.coalesce((skipped + repeated >= FAULTY_SHARE) & (lag_s <= FASTEST_LAG) & (neighbours_s <= FASTEST_LAG), F.lit(False))


def supported_rate(stated: Column, own: Column, factor: float = 10.0) -> Column:
    """The stated rate, unless it is more than ``factor`` times off the measured one.  One that
    is missing or not positive stays as it is: nothing was stated to be off."""
    said = stated.isNotNull() & ~F.isnan(stated) & (stated > 0) & (stated < float("inf"))
    off = said & own.isNotNull() & ~((own / factor <= stated) & (stated <= own * factor))
    return F.when(off, F.round(own, 3)).otherwise(stated)


def placed_clock(df: DataFrame, keys: list[str], order: list[str], t: str, rate: Column) -> DataFrame:
    """``df`` with problem (nonfinite, backwards, tied, or null) and placed: times of the
    key as they are, or with a problem one row every 1 / ``rate`` seconds from the first
    stamp (0 where that is none).  Only a clock of one stamp is tied."""
    w, whole = Window.partitionBy(*keys).orderBy(*order), Window.partitionBy(*keys)
    x = reading(F.col(t))
    d = df.withColumns({"_k": F.row_number().over(w) - 1, "_x": x}).withColumn("_back", F.col("_x") < F.lag("_x").over(w))
    d = d.withColumns({"_bad": F.bool_or(F.col("_x").isNull()).over(whole), "_any": F.bool_or(F.coalesce("_back", F.lit(False))).over(whole), "_one": (F.min("_x").over(whole) == F.max("_x").over(whole)) & (F.count("*").over(whole) > 1), "_first": F.coalesce(F.first("_x").over(w), F.lit(0.0))})
    d = d.withColumn("problem", F.when(F.col("_bad"), "nonfinite").when(F.col("_any"), "backwards").when(F.col("_one"), "tied"))
    placed = F.when(F.col("problem").isNull(), F.col("_x")).otherwise(F.col("_first") + F.col("_k") / rate)
    return d.withColumn("placed", placed).drop("_k", "_x", "_back", "_bad", "_any", "_one", "_first")


def shown(df: DataFrame, keys: list[str], t: str, lead: float = 0.0, step: float = 1 / 30) -> DataFrame:
    """``df`` with shown_from and shown_until: each row from halfway after the one before to
    halfway before the next; the first ``lead`` before its own time (never below 0), the
    last for half its step (half of ``step`` where it is alone)."""
    w = Window.partitionBy(*keys).orderBy(t)
    was, then = F.lag(t).over(w), F.lead(t).over(w)
    begin = F.coalesce((F.col(t) + was) / 2, F.greatest(F.lit(0.0), F.col(t) - lead))
    return df.withColumns({"shown_from": begin, "shown_until": F.coalesce((F.col(t) + then) / 2, F.col(t) + F.coalesce(F.col(t) - was, F.lit(step)) / 2)})


def cadence(df: DataFrame, keys: list[str], t: str, still: Column, moving_every: float, still_every: float) -> DataFrame:
    """Rows to sample: of each stretch that is still or moving the first row and then the
    first one of every period since, and the first and last row of the key."""
    w = Window.partitionBy(*keys).orderBy(t)
    d = df.withColumn("_s", F.coalesce(still, F.lit(False)))
    d = d.withColumn("_run", F.sum((~F.col("_s").eqNullSafe(F.lag("_s").over(w))).cast("int")).over(w))
    own = Window.partitionBy(*keys, "_run").orderBy(t)
    period = F.when(F.col("_s"), still_every).otherwise(moving_every)
    d = d.withColumn("_p", F.floor((F.col(t) - F.first(t).over(own)) / period))
    d = d.withColumns({"_new": ~F.col("_p").eqNullSafe(F.lag("_p").over(own)), "_end": F.lead(t).over(w).isNull()})
    return d.where(F.col("_new") | F.col("_end")).drop("_s", "_run", "_p", "_new", "_end")


def interval_motion(df: DataFrame, keys: list[str], order: str, marks: Column, values: list[str]) -> DataFrame:
    """Between rows that ``marks`` chooses (both included): keys, a and b (their orders), net
    move and the largest single step of the point ``values``; null where a reading lacks."""
    w = Window.partitionBy(*keys).orderBy(order)
    d = df.withColumns({f"_v{j}": reading(F.col(v)) for j, v in enumerate(values)})
    point = F.array(*(F.col(f"_v{j}") for j in range(len(values))))
    far = lambda p, q: F.sqrt(F.aggregate(F.zip_with(p, q, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    d = d.withColumn("_p", point).withColumns({"_step": far(F.col("_p"), F.lag("_p").over(w)), "_mark": marks})
    d = d.withColumn("_i", F.sum(F.col("_mark").cast("int")).over(w))
    inside = d.where("_i > 0").groupBy(*keys, "_i").agg(F.min(F.struct(order, "_p")).alias("_a"), F.max(F.when(~F.col("_mark"), F.col("_step"))).alias("_most"), F.count_if(F.exists("_p", lambda x: x.isNull())).alias("_lost"))
    closing = d.where("_mark").select(*keys, (F.col("_i") - 1).alias("_i"), F.struct(order, "_p").alias("_b"), F.col("_step").alias("_last"))
    met = inside.join(closing, [*keys, "_i"])
    lost = (F.col("_lost") > 0) | F.exists("_b._p", lambda x: x.isNull())
    return met.select(*keys, F.col(f"_a.{order}").alias("a"), F.col(f"_b.{order}").alias("b"), F.when(~lost, far(F.col("_a._p"), F.col("_b._p"))).alias("move"), F.when(~lost, F.greatest(F.coalesce("_most", F.lit(0.0)), F.col("_last"))).alias("largest_step"))


def blended(df: DataFrame, keys: list[str], frame: str, place: str, width: str, value: str) -> DataFrame:
    """keys, frame and blend: values of overlapping windows for one frame, each weighted by
    a triangle over its window (``place`` from 0 in a window of ``width`` frames)."""
    w = F.least(F.col(place) + 1, F.col(width) - F.col(place)).cast("double")
    return df.groupBy(*keys, frame).agg((F.sum(w * F.col(value)) / F.sum(w)).alias("blend"))


def window_starts(df: DataFrame, n: Column, width: int, stride: int) -> DataFrame:
    """``df`` with one row for each window of ``width`` over ``n`` frames: start, every
    ``stride`` frames and a last one flush with the end; a short recording has one."""
    return df.withColumn("start", F.explode(numbers.window_starts(n.cast("long"), width, stride)))


def fair_shares(df: DataFrame, keys: list[str], order: list[str], size: str, budget: float) -> DataFrame:
    """``df`` with share: how much of ``budget`` each row of a key keeps.  Where all fits,
    all; else small rows keep all of theirs and the others an equal whole share, the
    first of them (in ``order``) one more while any is left."""
    up = Window.partitionBy(*keys).orderBy(size, *order)
    whole = Window.partitionBy(*keys)
    d = df.withColumns({"_k": F.row_number().over(up) - 1, "_before": F.coalesce(F.sum(size).over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "_n": F.count("*").over(whole), "_all": F.sum(size).over(whole)})
    d = d.withColumn("_level", F.floor((F.lit(budget) - F.col("_before")) / (F.col("_n") - F.col("_k"))))
    # The level at which the first row, by size, doesn't fit.
    d = d.withColumn("_cut", F.min_by(F.when(F.col(size) > F.col("_level"), F.col("_level")), F.when(F.col(size) > F.col("_level"), F.col("_k"))).over(whole))
    d = d.withColumn("_own", F.when(F.col("_all") <= budget, F.col(size)).otherwise(F.least(F.col(size), F.col("_cut"))))
    d = d.withColumn("_spare", F.lit(budget) - F.sum("_own").over(whole))
    short = Window.partitionBy(*keys, (F.col("_own") < F.col(size))).orderBy(*order)
    extra = (F.col("_own") < F.col(size)) & (F.row_number().over(short) <= F.col("_spare"))
    return d.withColumn("share", (F.col("_own") + extra.cast("int")).cast("long")).drop("_k", "_before", "_n", "_all", "_level", "_cut", "_own", "_spare")


#: The narrow band that holds a level, the least share of active (and of resting) readings.
HELD, LEAST = 0.02, 0.02


def behaviour(df: DataFrame, keys: list[str], value: str, levels: DataFrame, swings: DataFrame) -> DataFrame:
    """keys and how a signal behaves about its rest: direction (up, down or null: the way of
    four fifths of its active readings, if it hardly passes its rest the other way),
    has_rest (holds one level when at rest), touch_like (both, at rest and active often enough)."""
    d = df.join(levels.select(*keys, "level"), keys).join(swings.select(*keys, "swing"), keys).withColumn("_d", reading(F.col(value)) - F.col("level"))
    far, sw = F.abs("_d"), F.col("swing")
    away = far > BAND * sw
    top = d.groupBy(*keys, "swing").agg(
        F.count("_d").alias("_n"), F.count_if(away).alias("_act"), F.count_if(away & (F.col("_d") > 0)).alias("_up"), F.max("_d").alias("_hi"), F.min("_d").alias("_lo"),
        F.count_if(far <= BAND * sw).alias("_near"), F.count_if(far <= HELD * sw).alias("_in"), F.max(F.when(away, far).otherwise(0.0)).alias("_most"),
    )
    for name, x in (("_over", F.col("_d")), ("_under", -F.col("_d"))):
        top = top.join(quantiles(d, keys, F.greatest(x, F.lit(0.0)), {name: 0.99}), keys)
    on = d.join(top.select(*keys, "_most"), keys).groupBy(*keys).agg(F.count_if(away & (far >= BAND * F.col("_most"))).alias("_on"))
    up, down = F.col("_up") * 5 >= F.col("_act") * 4, F.col("_up") * 5 <= F.col("_act")
    moves = (sw > 0) & (F.col("_act") > 0)
    direction = F.when(moves & up & (F.col("_under") <= BAND * F.col("_hi")), "up").when(moves & ~up & down & (F.col("_over") <= -BAND * F.col("_lo")), "down")
    rests = (sw > 0) & (F.col("_near") > 0) & (F.col("_near") >= LEAST * F.col("_n")) & (F.col("_in") >= HOLD * F.col("_near"))
    both = (F.col("_n") >= 5) & (F.col("_most") > 0) & (F.col("_n") - F.col("_on") >= LEAST * F.col("_n")) & (F.col("_on") >= LEAST * F.col("_n"))
    named = top.join(on, keys).withColumns({"direction": direction, "has_rest": F.coalesce(rests, F.lit(False))})
    return named.select(*keys, "direction", "has_rest", (F.col("has_rest") & F.col("direction").isNotNull() & F.coalesce(both, F.lit(False))).alias("touch_like"))


def localized(df: DataFrame, keys: list[str], frame: str, value: str, levels: DataFrame, swings: DataFrame, rests: DataFrame) -> DataFrame:
    """keys and localized: whether a signal of many values has a rest (``rests``: keys, has_rest)
    and in the median of the frames with an active value fewer than half of them are active,
    those further from rest than a tenth of the swing."""
    d = df.join(levels.select(*keys, "level"), keys).join(swings.select(*keys, "swing"), keys)
    away = F.coalesce(F.abs(reading(F.col(value)) - F.col("level")) > BAND * F.col("swing"), F.lit(False))
    share = d.groupBy(*keys, frame).agg(F.avg(away.cast("double")).alias("_share")).where("_share > 0")
    middle = quantiles(share, keys, F.col("_share"), {"_middle": 0.5})
    return rests.join(middle, keys, "left").select(*keys, (F.coalesce("has_rest", F.lit(False)) & F.coalesce(F.col("_middle") < 0.5, F.lit(False))).alias("localized"))


def on_log_scale(x: Column, near: float, far: float) -> Column:
    """1 at ``near`` and less, 0 at ``far`` and more, by the logarithm between."""
    held = F.greatest(F.lit(near), F.least(F.lit(far), x))
    return 1 - (F.ln(held) - F.ln(F.lit(near))) / (F.ln(F.lit(far)) - F.ln(F.lit(near)))

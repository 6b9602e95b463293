"""Operators over ordered rows: runs, sessions, steps, rates, jumps, lags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def runs(df: DataFrame, keys: list[str], order: list[str], value: str, broken: Column | None = None) -> DataFrame:
    """``df`` with run, the number (from 0) of its stretch of equal values within
    the key; nulls are equal, and a true ``broken`` starts a new run."""
    w = Window.partitionBy(*keys).orderBy(*order)
    same = F.lag(F.struct(value)).over(w).eqNullSafe(F.struct(value))
    fresh = ~same | F.coalesce(broken, F.lit(False)) if broken is not None else ~same
    return df.withColumn("_new", F.when(fresh, 1).otherwise(0)).withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).drop("_new")


def spans(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Each run as one row: keys, run, value, s and e (first and last place), n."""
    r = runs(df, keys, [order], value)
    return r.groupBy(*keys, "run", value).agg(F.min(order).alias("s"), F.max(order).alias("e"), F.count("*").alias("n"))


def sessions(df: DataFrame, keys: list[str], t: str, gap: float, tie: str | None = None) -> DataFrame:
    """``df`` with session, from 0; a gap over ``gap`` since the row before starts one."""
    w = Window.partitionBy(*keys).orderBy(t, *([tie] if tie else []))
    far = F.coalesce(F.col(t) - F.lag(t).over(w) > gap, F.lit(False))
    return df.withColumn("_f", far.cast("int")).withColumn("session", F.sum("_f").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_f")


def rolling_median(df: DataFrame, keys: list[str], order: list[str], value: str, half: int = 3, name: str = "rolling") -> DataFrame:
    """The centred median over 2 * half + 1 rows, shorter at the ends."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-half, half)
    return df.withColumn(name, median_of(F.collect_list(value).over(w)))


def median_of(values: Column) -> Column:
    """The median of an array without nulls; null when empty."""
    s, n = F.array_sort(values), F.size(values)
    lo = F.element_at(s, F.floor((n + 1) / 2).cast("int"))
    hi = F.element_at(s, F.floor((n + 2) / 2).cast("int"))
    return F.when(n > 0, (lo + hi) / 2)


def steps(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """``df`` with before, after, step and ratio: the row's step over the mean of
    its neighbours' steps (null at the ends or where that mean is 0)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    d = df.withColumn("step", F.abs(F.col(value) - F.lag(value).over(w)))
    d = d.withColumns({"before": F.lag("step").over(w), "after": F.lead("step").over(w)})
    mean = (F.col("before") + F.col("after")) / 2
    return d.withColumn("ratio", F.when(mean > 0, F.col("step") / mean))


def jumps(df: DataFrame, keys: list[str], order: list[str], value: str, floor: float, factor: float = 5.0, isolation: float = 3.0, largest: int = 6, most: int = 3) -> DataFrame:
    """Isolated jumps: of the ``largest`` steps of a key those of at least
    max(floor, factor * the 95th percentile) and ``isolation`` times both
    neighbours, at most ``most``, the largest first."""
    d = steps(df, keys, order, value)
    p95 = d.groupBy(*keys).agg(F.percentile("step", 0.95).alias("p95"))
    rank = Window.partitionBy(*keys).orderBy(F.desc("step"), *order)
    top = d.where("step is not null").withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= largest)
    big = F.col("step") >= F.greatest(F.lit(floor), factor * F.col("p95"))
    alone = (F.col("step") >= isolation * F.coalesce("before", F.lit(0.0))) & (F.col("step") >= isolation * F.coalesce("after", F.lit(0.0)))
    kept = top.join(p95, keys).where(big & alone).withColumn("rank", F.row_number().over(rank))
    return kept.where(F.col("rank") <= most)


def clock_report(df: DataFrame, keys: list[str], t: str) -> DataFrame:
    """Per key: n, median_step, longest gap, gaps over 1.5 medians, span rate,
    median rate, and rate: the median-step rate unless the span rate without
    long gaps differs from it by over 2 per cent, then that one."""
    w = Window.partitionBy(*keys).orderBy(t)
    d = df.withColumn("_dt", F.col(t) - F.lag(t).over(w))
    base = d.groupBy(*keys).agg(F.count("*").alias("n"), F.percentile("_dt", 0.5).alias("median_step"), F.max("_dt").alias("longest"), F.min(t).alias("_a"), F.max(t).alias("_b"))
    long = d.join(base.select(*keys, "median_step"), keys).groupBy(*keys).agg(
        F.count_if(F.col("_dt") > 1.5 * F.col("median_step")).alias("gaps"),
        F.sum(F.when(F.col("_dt") <= 1.5 * F.col("median_step"), F.col("_dt"))).alias("_live"),
        F.count_if(F.col("_dt") <= 1.5 * F.col("median_step")).alias("_k"),
    )
    rate = lambda n, s: F.when(s > 0, n / s)
    out = base.join(long, keys).withColumns({"span_rate": rate(F.col("n") - 1, F.col("_b") - F.col("_a")), "median_rate": rate(F.lit(1.0), F.col("median_step")), "_paused": rate(F.col("_k"), F.col("_live"))})
    differs = F.abs(F.col("median_rate") - F.col("_paused")) > 0.02 * F.col("_paused")
    return out.withColumn("rate", F.when(differs, F.col("_paused")).otherwise(F.col("median_rate"))).drop("_a", "_b", "_live", "_k", "_paused")


def jitter(df: DataFrame, keys: list[str], order: list[str], value: str, still: float) -> DataFrame:
    """Shares of moving steps (neighbours' mean over ``still``) that skip
    (1.5 times the mean or more) and that repeat (a tenth of it or less)."""
    d = steps(df, keys, order, value).where(F.col("ratio").isNotNull() & ((F.col("before") + F.col("after")) / 2 > still))
    return d.groupBy(*keys).agg(F.count("*").alias("moving"), F.avg((F.col("ratio") >= 1.5).cast("double")).alias("skipped"), F.avg((F.col("ratio") <= 0.1).cast("double")).alias("repeated"))


def lagged_correlation(df: DataFrame, keys: list[str], order: list[str], x: str, y: str, lags: range) -> DataFrame:
    """corr(x, y shifted by lag) for each lag, one pass over the ordered rows."""
    w = Window.partitionBy(*keys).orderBy(*order)
    wide = df.select(*keys, *order, x, *(F.lead(y, k).over(w).alias(f"_y{k}") for k in lags))
    long = wide.select(*keys, x, F.explode(F.array(*(F.struct(F.lit(k).alias("lag"), F.col(f"_y{k}").alias("yy")) for k in lags))).alias("p"))
    return long.where("p.yy is not null").groupBy(*keys, F.col("p.lag").alias("lag")).agg(F.count("*").alias("n"), F.when(F.count("*") >= 3, F.corr(x, "p.yy")).alias("r"))


def moving_sum(df: DataFrame, keys: list[str], order: list[str], value: str, half: int, name: str = "moving") -> DataFrame:
    return df.withColumn(name, F.sum(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(-half, half)))


def bucket_extrema(df: DataFrame, keys: list[str], order: str, value: str, buckets: int) -> DataFrame:
    """First and last row of a key and the rows with the least and greatest value
    of each of ``buckets`` equal parts (ties to the earlier): a thin outline."""
    w = Window.partitionBy(*keys).orderBy(order)
    d = df.withColumns({"_b": F.ntile(buckets).over(w), "_k": F.row_number().over(w), "_n": F.count("*").over(Window.partitionBy(*keys))})
    part = Window.partitionBy(*keys, "_b")
    lo = F.row_number().over(part.orderBy(value, order))
    hi = F.row_number().over(part.orderBy(F.desc(value), order))
    return d.withColumns({"_lo": lo, "_hi": hi}).where("_lo = 1 or _hi = 1 or _k = 1 or _k = _n").drop("_b", "_k", "_n", "_lo", "_hi")


def spread_ties(df: DataFrame, keys: list[str], t: str, tie: str) -> DataFrame:
    """Rows with one time stamp spread evenly up to the next stamp of the key (the
    last group keeps its stamp); new column placed."""
    same = Window.partitionBy(*keys, t)
    d = df.withColumns({"_n": F.count("*").over(same), "_k": F.row_number().over(same.orderBy(tie))})
    stamps = df.select(*keys, t).distinct().withColumn("_next", F.lead(t).over(Window.partitionBy(*keys).orderBy(t)))
    room = F.coalesce(F.col("_next") - F.col(t), F.lit(0.0))
    return d.join(stamps, [*keys, t]).withColumn("placed", F.col(t) + room * (F.col("_k") - 1) / F.col("_n")).drop("_n", "_k", "_next")


def robust_outliers(df: DataFrame, keys: list[str], value: str, deviations: float = 10.0) -> DataFrame:
    """Rows further than ``deviations`` median absolute deviations from their
    key's median, with both; a key without spread has none."""
    mid = df.groupBy(*keys).agg(F.percentile(value, 0.5).alias("median"))
    d = df.join(mid, keys).withColumn("_a", F.abs(F.col(value) - F.col("median")))
    mad = d.groupBy(*keys).agg(F.percentile("_a", 0.5).alias("mad"))
    return d.join(mad, keys).where((F.col("mad") > 0) & (F.col("_a") > deviations * F.col("mad"))).drop("_a")

"""What arrays of values say in few numbers: changes, activity, peaks, rounding, filtered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from spanloom.operators.signals import BAND, reading
from spanloom.session import stored


def readings(values: Column) -> Column:
    """An array of numbers as doubles, null where one is no finite number."""
    return F.transform(values, lambda x: reading(x))


def quantile(ordered: Column, q: float) -> Column:
    """A quantile of an ascending array without nulls, on a straight line between neighbours."""
    place = (F.size(ordered) - 1) * F.lit(q)
    low = F.floor(place).cast("int")
    a = F.get(ordered, low)
    return a + (F.coalesce(F.get(ordered, low + 1), a) - a) * (place - low)


def component_change(before: Column, after: Column, threshold: Column | float, top: int = 5) -> Column:
    """How the values of an array changed, as a struct: changed (by more than ``threshold``), rising,
    falling, compared (values with a reading at both), mean_change, the median, 90 % point and
    greatest of the absolute changes, and largest, the ``top`` greatest (place, change) that aren't
    zero, ties by place.  Null where no value has a reading at both."""
    threshold = F.lit(threshold) if isinstance(threshold, float) else threshold
    both = F.zip_with(readings(before), readings(after), lambda a, b: b - a)
    placed = F.filter(F.transform(both, lambda d, i: F.struct((-F.abs(d)).alias("size"), i.alias("i"), d.alias("d"))), lambda x: x["d"].isNotNull())
    d = F.transform(placed, lambda x: x["d"])
    size = F.array_sort(F.transform(d, lambda x: F.abs(x)))
    count = lambda rule: F.size(F.filter(d, rule)).cast("long")
    order = F.slice(F.filter(F.array_sort(placed), lambda x: x["d"] != 0), 1, top)
    out = F.struct(
        count(lambda x: F.abs(x) > threshold).alias("changed"), count(lambda x: x > threshold).alias("rising"), count(lambda x: x < -threshold).alias("falling"), F.size(d).cast("long").alias("compared"),
        F.try_divide(F.aggregate(d, F.lit(0.0), lambda s, x: s + x), F.size(d)).alias("mean_change"), quantile(size, 0.5).alias("median"), quantile(size, 0.9).alias("p90"), F.array_max(size).alias("greatest"),
        F.transform(order, lambda x: F.struct(x["i"].alias("place"), x["d"].alias("change"))).alias("largest"),
    )
    return F.when(F.size(d) > 0, out)


def instant_changes(df: DataFrame, keys: list[str], order: str, values: str, instants: Column, threshold: Column | float) -> DataFrame:
    """keys, ``order`` and change (see ``component_change``) of every instant since the one before it."""
    w = Window.partitionBy(*keys).orderBy(order)
    d = df.where(instants).withColumn("_was", F.lag(values).over(w))
    return d.select(*keys, order, component_change(F.col("_was"), F.col(values), threshold).alias("change"))


def row_steps(df: DataFrame, keys: list[str], order: str, values: str) -> DataFrame:
    """keys, ``order`` and moved: the summed absolute change of all values since the row before."""
    w = Window.partitionBy(*keys).orderBy(order)
    d = F.zip_with(readings(F.lag(values).over(w)), readings(F.col(values)), lambda a, b: F.abs(b - a))
    return df.select(*keys, order, F.aggregate(F.coalesce(d, F.array().cast("array<double>")), F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0))).alias("moved"))


def activity(df: DataFrame, keys: list[str], values: str, width: int, levels: DataFrame, swings: DataFrame) -> DataFrame:
    """``df`` with total (how far the active values are from rest together), active (how many
    are further than a tenth of the swing), strongest_row and strongest_column on a map of
    ``width`` columns (the first of equals).  All null where no value has a reading; the strongest
    where none is active."""
    d = df.join(levels.select(*keys, "level"), keys, "left").join(swings.select(*keys, "swing"), keys, "left")
    far = F.transform(readings(F.col(values)), lambda x: F.abs(x - F.col("level")))
    d = d.withColumn("_far", F.transform(far, lambda x, i: F.struct(x.alias("x"), (-i).alias("i"))))
    on = F.filter("_far", lambda s: (s["x"] > BAND * F.col("swing")) & (F.col("swing") > 0))
    d = d.withColumns({"_on": on, "_read": F.exists("_far", lambda s: s["x"].isNotNull())})
    top = -F.array_max("_on")["i"]
    some = F.col("_read") & (F.size("_on") > 0)
    return d.withColumns({
        "total": F.when(F.col("_read"), F.aggregate("_on", F.lit(0.0), lambda s, x: s + x["x"])), "active": F.when(F.col("_read"), F.size("_on").cast("long")),
        "strongest_row": F.when(some, F.floor(top / width).cast("int")), "strongest_column": F.when(some, (top % width).cast("int")),
    }).drop("_far", "_on", "_read", "level", "swing")


def rounding_only(df: DataFrame, keys: list[str], value: str, swings: DataFrame, states: int = 8) -> DataFrame:
    """keys and rounding: whether a signal of more than ``states`` different readings swings by no more
    than the smallest step between two of them.  Readings are reduced to distinct ones first."""
    distinct = df.select(*keys, reading(F.col(value)).alias("_x")).where("_x is not null").distinct()
    d = distinct.withColumn("_gap", F.col("_x") - F.lag("_x").over(Window.partitionBy(*keys).orderBy("_x")))
    g = d.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_gap").alias("_least"))
    small = (F.col("_n") > states) & (F.col("swing") <= F.col("_least") * (1 + 1e-6))
    return swings.join(g, keys, "left").select(*keys, F.coalesce(small, F.lit(False)).alias("rounding"))


def spaced_peaks(df: DataFrame, keys: list[str], place: str, size: str, gap: float, most: int | None = None) -> DataFrame:
    """Rows taken from the greatest ``size`` on (ties: the smaller ``place``), none nearer than ``gap``
    to one taken before it, at most ``most`` a key.

    A row that is the greatest of all that are left around it is taken whatever lies
    elsewhere, and those around it go, so each round settles many places at once.
    """
    x = F.struct(F.col(size).alias("s"), (-F.col(place)).alias("p"))
    left = stored(df.where(F.col(size).isNotNull() & F.col(place).isNotNull()).withColumns({"_x": x, "_at": F.col(place).cast("double")}), "candidates")
    taken = None
    reach = gap - 1e-9 * max(1.0, abs(gap))
    frame = f"over (partition by {', '.join(f'`{k}`' for k in keys)} order by _at range between {reach!r}D preceding and {reach!r}D following)"
    while not left.isEmpty():
        judged = left.withColumn("_peak", F.expr(f"max(_x) {frame}") == F.col("_x"))
        judged = stored(judged.withColumn("_gone", F.expr(f"max(cast(_peak as int)) {frame}") == 1), "peaks")
        own = judged.where("_peak").drop("_peak", "_gone")
        taken = own if taken is None else taken.unionByName(own)
        left = judged.where("not _gone").drop("_peak", "_gone")
    if taken is None:
        return df.limit(0)
    if most is not None:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_x")))
        taken = taken.withColumn("_k", rank).where(F.col("_k") <= most).drop("_k")
    return taken.drop("_x", "_at")


def agreeing_rows(df: DataFrame, keys: list[str], order: str, t: str, top: str, bottom: str, tolerance: float, gap_s: float = 0.5, smooth_s: float = 0.2, least: int = 10) -> DataFrame:
    """keys, ``order``, opening, observed and filled: ``bottom`` where it agrees with the line that ``top``
    foretells it by, smoothed and filled.

    A row is observed where both have a reading and bottom lies within ``tolerance`` (a share)
    of the line (of its median where top moves by less than 1).  The median of five
    observed neighbours within ``smooth_s`` seconds takes its place; rows between two observed ones
    at most ``gap_s`` apart lie on a line between them.  A key with fewer than ``least`` rows of
    both has none.
    """
    d = df.select(*keys, order, reading(F.col(t)).alias("_t"), reading(F.col(top)).alias("_a"), reading(F.col(bottom)).alias("_b"))
    both = d.where("_a is not null and _b is not null")
    fit = both.groupBy(*keys).agg(F.count("*").alias("_n"), (F.max("_a") - F.min("_a")).alias("_span"), F.covar_pop("_a", "_b").alias("_ab"), F.var_pop("_a").alias("_aa"), F.avg("_a").alias("_ma"), F.avg("_b").alias("_mb"), F.percentile("_b", 0.5).alias("_mid"))
    slope = F.try_divide("_ab", "_aa")
    d = d.join(fit, keys, "left").withColumn("_line", F.when(F.col("_span") < 1, F.col("_mid")).otherwise(F.col("_mb") + slope * (F.col("_a") - F.col("_ma"))))
    seen = (F.col("_n") >= least) & F.col("_a").isNotNull() & F.col("_b").isNotNull() & (F.abs(F.col("_b") - F.col("_line")) <= tolerance * F.abs("_line"))
    d = d.withColumn("observed", F.coalesce(seen, F.lit(False))).withColumn("_o", F.when(F.col("observed"), F.col("_b")))
    w = Window.partitionBy(*keys).orderBy(order)
    five = w.rowsBetween(-2, 2)
    near = F.collect_list(F.struct("_o", "_t")).over(five)
    d = d.withColumn("_w", near)
    whole = ~F.exists("_w", lambda x: x["_o"].isNull()) & (F.element_at("_w", -1)["_t"] - F.element_at("_w", 1)["_t"] <= smooth_s)
    mid = quantile(F.array_sort(F.transform("_w", lambda x: x["_o"])), 0.5)
    d = d.withColumn("_s", F.when(F.col("observed"), F.when(F.coalesce(whole, F.lit(False)), mid).otherwise(F.col("_o"))))
    point = F.when(F.col("observed"), F.struct("_t", "_s"))
    d = d.withColumns({"_p": F.last(point, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), "_q": F.first(point, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))})
    apart = F.col("_q._t") - F.col("_p._t")
    filled = ~F.col("observed") & F.coalesce(apart <= gap_s, F.lit(False))
    placed = F.col("_p._s") + (F.col("_q._s") - F.col("_p._s")) * F.try_divide(F.col("_t") - F.col("_p._t"), apart)
    d = d.withColumn("filled", filled)
    return d.select(*keys, order, F.when(F.col("observed"), F.col("_s")).when(F.col("filled"), placed).alias("opening"), "observed", "filled")

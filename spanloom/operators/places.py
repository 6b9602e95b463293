"""Places and running sums over a whole table, without one task that orders all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from spanloom.session import stored

#: Spark numbers rows of a partition from its number shifted by so many bits.
BITS = 33


def placed(df: DataFrame, order: list[Column | str], sums: dict[str, str] | None = None) -> DataFrame:
    """``df`` with place (from 0, in a total order of all rows) and, for every name in ``sums``, the
    sum of that column up to and with the row (nulls count 0).

    Rows are cut into ranges, each is numbered where it lies, and what stands before a
    range comes from one row a range, so that is what one task adds up and all get.
    """
    sums = sums or {}
    d = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id()), "ordered")
    d = d.withColumns({"_p": F.shiftright("_m", BITS), "_k": F.col("_m") % (1 << BITS)})
    own = d.groupBy("_p").agg(F.count("*").alias("_n"), *(F.coalesce(F.sum(c), F.lit(0.0)).alias("_s_" + n) for n, c in sums.items()))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    before = own.select("_p", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_o"), *(F.coalesce(F.sum("_s_" + n).over(w), F.lit(0.0)).alias("_o_" + n) for n in sums))
    inside = Window.partitionBy("_p").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    out = d.join(F.broadcast(before), "_p")
    added = {n: F.col("_o_" + n) + F.coalesce(F.sum(c).over(inside), F.lit(0.0)) for n, c in sums.items()}
    return out.withColumns({"place": (F.col("_o") + F.col("_k")).cast("long"), **added}).select(*df.columns, "place", *sums)


def tile(place: Column, n: Column, tiles: int) -> Column:
    """The tile (from 1) of a place among ``n``: sizes differ by one at most, greater ones first."""
    size, more = F.floor(n / tiles), n % tiles
    return F.when(place < more * (size + 1), F.floor(place / (size + 1)) + 1).otherwise(more + F.floor((place - more * (size + 1)) / F.greatest(size, F.lit(1))) + 1).cast("int")


def in_chunks(df: DataFrame, size: int, half: int, name: str = "chunk") -> DataFrame:
    """Rows with a ``place`` in chunks of ``size`` places, each with ``half`` rows of its neighbours;
    inner says whether a row is the chunk's own."""
    own, at = F.floor(F.col("place") / size), F.col("place") % size
    chunks = F.array_compact(F.array(own, F.when((at < half) & (own > 0), own - 1), F.when(at >= size - half, own + 1)))
    return df.withColumn(name, F.explode(chunks)).withColumn("inner", F.col(name) == own)


def quantiles(df: DataFrame, keys: list[str], value: Column, shares: dict[str, float]) -> DataFrame:
    """keys and, for every name, the point of ``value`` below which that share of a key's values
    lies, as ``percentile`` has it (between two values in proportion; nulls left out, a key
    without values null).

    ``percentile`` holds all of a key's values in one task.  Here equal values are
    counted and ranked in ranges of all keys, so a task holds no more than its range.
    """
    rows = df.select(*keys, value.alias("_v"))
    counts = placed(rows.groupBy(*keys, "_v").agg(F.count("_v").alias("_c")), [*keys, "_v"], {"_upto": "_c"})
    own = counts.groupBy(*keys).agg(F.sum("_c").alias("_n"), F.min(F.col("_upto") - F.col("_c")).alias("_start"))
    same = [counts[k].eqNullSafe(F.col("_k_" + k)) for k in keys]
    d = counts.where("_c > 0").join(own.select(*(F.col(k).alias("_k_" + k) for k in keys), "_n", "_start"), same)
    last = F.col("_upto") - F.col("_start")
    at = lambda k: F.max(F.when((last - F.col("_c") <= k) & (k < last), F.col("_v")))
    spot = lambda p: F.lit(p) * (F.col("_n") - 1)
    ends = [c for n, p in shares.items() for c in (at(F.floor(spot(p))).alias("_lo_" + n), at(F.ceil(spot(p))).alias("_hi_" + n))]
    found = d.groupBy(*("_k_" + k for k in keys), "_n").agg(*ends)
    between = lambda n, p: F.when(F.col("_lo_" + n) == F.col("_hi_" + n), F.col("_lo_" + n)).otherwise((F.ceil(spot(p)) - spot(p)) * F.col("_lo_" + n) + (spot(p) - F.floor(spot(p))) * F.col("_hi_" + n))
    points = found.select(*(F.col("_k_" + k) for k in keys), *(between(n, p).alias(n) for n, p in shares.items()))
    every = own.select(*keys)
    return every.join(points, [every[k].eqNullSafe(points["_k_" + k]) for k in keys], "left").select(*keys, *shares)

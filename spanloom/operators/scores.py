"""Peer-relative scores: leave-one-out medians, ratios, weighted means, penalties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def leave_one_out_median(df: DataFrame, keys: list[str], value: str, tie: str, name: str = "peer_median") -> DataFrame:
    """The median of the other rows of a key, and peers, their number.

    From ranks only: without the row at rank r, the middle of what is left is
    one or two fixed ranks of the whole, shifted by one where they reach r.  So
    each key sends at most four order statistics to its rows, no list.
    """
    own = df.where(F.col(value).isNotNull())
    d = own.withColumns({"_r": F.row_number().over(Window.partitionBy(*keys).orderBy(value, tie)), "_n": F.count("*").over(Window.partitionBy(*keys))})
    m = F.col("_n") - 1
    lo, hi = F.floor((m + 1) / 2), F.floor((m + 2) / 2)
    ranked = d.groupBy(*keys).agg(*(F.max(F.when(F.col("_r") == F.floor((F.col("_n") + k) / 2), F.col(value))).alias(f"_v{k}") for k in (0, 1, 2, 3)))
    d = d.join(ranked, keys)
    at = lambda p: F.when(p < F.col("_r"), p).otherwise(p + 1)

    def value_at(rank: Column) -> Column:
        return F.coalesce(*(F.when(rank == F.floor((F.col("_n") + k) / 2), F.col(f"_v{k}")) for k in (0, 1, 2, 3)))

    out = d.withColumns({name: F.when(m > 0, (value_at(at(lo)) + value_at(at(hi))) / 2), "peers": m})
    return out.drop("_r", "_n", "_v0", "_v1", "_v2", "_v3")


def ratio_score(value: Column, median: Column, peers: Column, least: int = 5) -> Column:
    """10 * median / value between 0 and 10; null with fewer than ``least`` peers."""
    return F.when((peers >= least) & (value > 0), F.least(F.lit(10.0), F.greatest(F.lit(0.0), 10 * median / value)))


def weighted(parts: dict[str, float]) -> Column:
    """The weighted mean of columns, weights shared out anew over those present."""
    total = sum((F.when(F.col(c).isNotNull(), F.lit(w)).otherwise(0.0) for c, w in parts.items()), F.lit(0.0))
    worth = sum((F.coalesce(F.col(c) * w, F.lit(0.0)) for c, w in parts.items()), F.lit(0.0))
    return F.when(total > 0, worth / total)


def penalties(severity: Column, recovered: Column) -> Column:
    """Points off for a mistake: half of them where it was made good at once."""
    points = F.when(severity == "low", 0.5).when(severity == "medium", 1.5).when(severity == "high", 3.0)
    return F.when(recovered, points / 2).otherwise(points)

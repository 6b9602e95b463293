"""One result schema for data-quality checks, and a registry with versions.

A check is fired, clear, not_applicable or errored; errored is never clear.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Check:
    """applies: null or false means not assessed; fires: null means errored."""

    name: str
    version: int
    applies: Column
    fires: Column
    value: Column


def run_checks(df: DataFrame, keys: list[str], checks: list[Check]) -> DataFrame:
    """Long form: keys, check, version, status, value."""
    rows = F.array(*(
        F.struct(
            F.lit(c.name).alias("check"), F.lit(c.version).alias("version"),
            F.when(~F.coalesce(c.applies, F.lit(False)), "not_applicable").when(c.fires.isNull(), "errored").when(c.fires, "fired").otherwise("clear").alias("status"),
            c.value.cast("double").alias("value"),
        )
        for c in checks
    ))
    return df.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")


def stale(results: DataFrame, keys: list[str], checks: list[Check]) -> DataFrame:
    """Keys whose stored results miss a check, have an older version or an error."""
    wanted = F.create_map(*(x for c in checks for x in (F.lit(c.name), F.lit(c.version))))
    good = F.count_if((F.col("version") == wanted[F.col("check")]) & (F.col("status") != "errored"))
    return results.groupBy(*keys).agg(good.alias("current")).where(F.col("current") < len(checks)).select(*keys)


def rollup(results: DataFrame, keys: list[str]) -> DataFrame:
    """fired, clear, not_applicable and errored counts, and the worst status."""
    n = {s: F.count_if(F.col("status") == s).alias(s) for s in ("fired", "clear", "not_applicable", "errored")}
    out = results.groupBy(*keys).agg(*n.values())
    return out.withColumn("worst", F.when(F.col("errored") > 0, "errored").when(F.col("fired") > 0, "fired").when(F.col("clear") > 0, "clear").otherwise("not_applicable"))

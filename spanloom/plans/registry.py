"""All registered queries over the driver's tables and the SQL that checks them."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

FLAGSHIP = "session_summary"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def micros(ts: str) -> Column:
    """Whole microseconds since 1970 of a time stamp without zone."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {ts})")


def timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with t, seconds since 2024-01-01."""
    start = 1704067200000000
    return table(spark, sf_dir, "events").withColumn("t", (micros("ts") - start) / 1e6)


#: The same in SQL.
EVENTS = "WITH ev AS (SELECT *, (epoch_us(ts) - 1704067200000000) / 1e6 AS t FROM events)"

for _name in ("kernels", "events", "signals", "parts", "labels", "relational", "scoring", "documents", "nested", "arrays", "outputs"):
    importlib.import_module(f"spanloom.plans.{_name}")

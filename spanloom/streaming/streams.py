"""Structured Streaming forms: sessions, late data, duplicates, incremental tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from spanloom.session import new_folder
from spanloom.sources import files


def from_files(spark: SparkSession, path: str, schema: StructType, per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def sessions(events: DataFrame, key: str, ts: str, value: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Session windows per key with late rows up to ``late`` taken in."""
    w = F.session_window(F.col(ts), gap)
    return events.withWatermark(ts, late).groupBy(key, w.alias("w")).agg(F.count("*").alias("n"), F.sum(value).alias("total"))


def windows(events: DataFrame, keys: list[str], ts: str, value: str, length: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Tumbling (or sliding) windows."""
    w = F.window(F.col(ts), length, slide) if slide else F.window(F.col(ts), length)
    return events.withWatermark(ts, late).groupBy(*keys, w.alias("w")).agg(F.count("*").alias("n"), F.sum(value).alias("total"))


def without_repeats(events: DataFrame, ident: str, ts: str, late: str = "1 hour") -> DataFrame:
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark([ident])


def run_to_end(stream: DataFrame, mode: str = "append", keys: list[str] | None = None) -> DataFrame:
    """All that is there now, through a file sink or, in complete mode, as a table that each
    batch replaces; then the result as a batch.  In update mode a batch holds only the
    ``keys`` that have changed: each is kept under its number, and the last row of a key
    is the result; a batch that is run twice writes the same place."""
    spark = stream.sparkSession
    out, state = new_folder(spark, "stream"), new_folder(spark, "stream-state")
    if mode == "update" and not keys:
        raise ValueError("update mode needs the keys of a row")
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").start(out)
    elif mode == "update":
        query = writer.foreachBatch(lambda df, k: df.withColumn("_batch", F.lit(k).cast("long")).write.mode("overwrite").parquet(f"{out}/{k:012d}")).start()
    else:
        query = writer.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).start()
    query.awaitTermination()
    if mode != "update":
        return spark.read.schema(stream.schema).parquet(out)
    rows = spark.read.schema(StructType([*stream.schema.fields, StructField("_batch", LongType())])).option("recursiveFileLookup", True).parquet(out)
    # A batch may give a key several rows, in no order but that of what they say; the greatest of the last batch stays.
    last = rows.groupBy(*keys).agg(F.max(F.struct("_batch", *(c for c in stream.columns if c not in keys))).alias("_r"))
    return last.select(*(F.col(c) if c in keys else F.col("_r").getField(c).alias(c) for c in stream.columns))


def upsert(stream: DataFrame, path: str, key: str, version: str, name: str = "stream") -> None:
    """Fold a stream into the table published at ``path``, the highest version of a key winning.
    Each batch publishes a new generation in which only the buckets of its keys are new; the
    stream's own state lies beside them under ``name``, so a later call goes on where
    this one ended, and a batch that is run twice changes nothing."""
    fold = lambda df, _: files.merge(df, path, key, version)
    stream.writeStream.foreachBatch(fold).option("checkpointLocation", f"{path}/_state-{name}").trigger(availableNow=True).start().awaitTermination()


class Totals:
    """Per key a running count and sum across batches (applyInPandasWithState)."""

    schema, state = "user_id long, n long, total double", "n long, total double"

    @staticmethod
    def update(key, frames, state):
        import pandas as pd

        n, total = state.get if state.exists else (0, 0.0)
        for f in frames:
            n, total = n + len(f), total + float(f["value"].sum())
        state.update((n, total))
        yield pd.DataFrame({"user_id": [key[0]], "n": [n], "total": [total]})


def running_totals(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").applyInPandasWithState(Totals.update, Totals.schema, Totals.state, "update", "NoTimeout")

"""Round trips through sources and sinks, and streams run to their end."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.plans.registry import query, table
from spanloom.session import new_folder
from spanloom.sources import files
from spanloom.streaming import streams


def stream_of(spark, sf_dir):
    batch = table(spark, sf_dir, "events")
    # A pattern, since a stream over one plain file has no folder to list.
    return streams.from_files(spark, f"{sf_dir}/events.parque[t]", batch.schema).withColumn("at", F.col("ts").cast("timestamp"))


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def json_round_trip(spark, sf_dir):
    """Events as gzip JSON Lines in a folder per type, read back with errors kept."""
    path = new_folder(spark, "json")
    d = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    d.write.partitionBy("event_type").option("compression", "gzip").json(path)
    back = files.read_json_lines(spark, path, d.schema).where("_corrupt is null")
    return back.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY 1")
def csv_round_trip(spark, sf_dir):
    path = new_folder(spark, "csv")
    d = table(spark, sf_dir, "customer")
    d.write.option("header", True).csv(path)
    return files.read_csv(spark, path, d.schema).groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query('SELECT CAST(user_id AS VARCHAR) AS "key", count(*) AS n_rows FROM events GROUP BY 1')
def row_group_per_key(spark, sf_dir):
    """A Parquet file set with one row group for each user."""
    made = files.write_grouped(table(spark, sf_dir, "events"), new_folder(spark, "grouped"), "user_id", ["event_id"])
    return made.select("key", "n_rows")


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def publish_swap(spark, sf_dir):
    """A table published twice; readers see the second whole."""
    path = new_folder(spark, "published")
    d = table(spark, sf_dir, "orders")
    files.publish(d.where("o_orderkey % 3 = 0"), path)
    files.publish(d, path)
    return files.published(spark, path).groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0")
def resume_scan(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return files.remaining(o, o.where("o_orderkey % 3 = 0"), ["o_orderkey"])


@query("""WITH f AS (SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS f FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM f) SELECT user_id, count(*) AS n, round(sum(value), 4) AS total FROM s GROUP BY user_id, k""")
def stream_sessions(spark, sf_dir):
    out = streams.run_to_end(streams.sessions(stream_of(spark, sf_dir), "user_id", "at", "value"), "complete")
    return out.select("user_id", "n", F.round("total", 4).alias("total"))


@query("""SELECT event_type, epoch_us(ts) // 21600000000 AS slot, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def stream_windows(spark, sf_dir):
    out = streams.run_to_end(streams.windows(stream_of(spark, sf_dir), ["event_type"], "at", "value", "6 hours"), "complete")
    return out.select("event_type", F.floor(F.unix_micros("w.start") / 21600000000).alias("slot"), "n", F.round("total", 4).alias("total"))


@query("SELECT count(*) AS n, count(DISTINCT event_id) AS ids FROM events")
def stream_without_repeats(spark, sf_dir):
    out = streams.run_to_end(streams.without_repeats(stream_of(spark, sf_dir), "event_id", "at"))
    return out.agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("ids"))


@query("SELECT user_id, max(event_id) AS event_id, round(arg_max(value, event_id), 6) AS value FROM events GROUP BY 1")
def stream_upsert(spark, sf_dir):
    """Two streams folded into one table one after the other; the newest event of a user stays."""
    path = new_folder(spark, "upserted")
    for k in (1, 0):
        streams.upsert(stream_of(spark, sf_dir).select("user_id", "event_id", "value").where(F.col("event_id") % 2 == k), path, "user_id", "event_id", f"half-{k}")
    return files.published(spark, path).withColumn("value", F.round("value", 6))


@query("SELECT user_id, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def stream_running_totals(spark, sf_dir):
    out = streams.run_to_end(streams.running_totals(stream_of(spark, sf_dir)), "update", ["user_id"])
    return out.withColumn("total", F.round("total", 4))


@query("""SELECT o_orderpriority, count(*) AS n, count(o_custkey) AS customers FROM orders GROUP BY 1""")
def tables_of_two_makes(spark, sf_dir):
    """Files of like tables read by name, one without a column; listed, and the later reply preferred."""
    path = new_folder(spark, "makes")
    o = table(spark, sf_dir, "orders")
    o.select("o_orderkey", "o_orderpriority", F.lit(1).alias("reply")).write.parquet(f"{path}/a")
    o.select("o_custkey", "o_orderkey", "o_orderpriority", F.lit(2).alias("reply")).write.parquet(f"{path}/b")
    d = files.read_tables(spark, [f"{path}/a", f"{path}/b"])
    d = files.authoritative(d, ["o_orderkey"], [F.desc("reply")])
    if files.listing(spark, path, "*.parquet").where("bytes > 0").isEmpty():
        raise ValueError("nothing was written")
    return d.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.count("o_custkey").alias("customers"))

"""Relational queries over the order tables: joins, sets, grouping sets, top-k."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from spanloom.operators import places, sampling
from spanloom.plans.registry import query, table


def t(spark, sf_dir, *names):
    return [table(spark, sf_dir, n) for n in names]


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS discount
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def pricing_summary(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").where("l_shipdate <= timestamp_ntz'1998-09-02 00:00:00'")
    return d.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("discount"))


@query("""SELECT n_name, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def join_inner_chain(spark, sf_dir):
    o, c, n = t(spark, sf_dir, "orders", "customer", "nation")
    d = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return d.groupBy("n_name").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""SELECT c_custkey, count(o_orderkey) AS n, round(coalesce(sum(o_totalprice), 0), 2) AS total FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def join_left(spark, sf_dir):
    o, c = t(spark, sf_dir, "orders", "customer")
    spent = o.groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))
    d = c.join(spent, c.c_custkey == spent.o_custkey, "left")
    return d.select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"), F.round(F.coalesce("total", F.lit(0.0)), 2).alias("total"))


@query("""WITH a AS (SELECT o_custkey AS k, count(*) AS orders FROM orders GROUP BY 1), b AS (SELECT l_partkey AS k, count(*) AS lines FROM lineitem GROUP BY 1)
SELECT coalesce(a.k, b.k) AS key, orders, lines FROM a FULL JOIN b ON a.k = b.k""")
def join_full(spark, sf_dir):
    """Customers' orders beside the lines of the parts with their numbers; either may lack."""
    o, l = t(spark, sf_dir, "orders", "lineitem")
    a = o.groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").alias("orders"))
    return a.join(l.groupBy(F.col("l_partkey").alias("key")).agg(F.count("*").alias("lines")), "key", "full")


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def join_semi(spark, sf_dir):
    o, c = t(spark, sf_dir, "orders", "customer")
    return c.join(o.where("o_orderpriority = '1-URGENT'"), c.c_custkey == o.o_custkey, "left_semi").select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def join_anti(spark, sf_dir):
    o, c = t(spark, sf_dir, "orders", "customer")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey", "c_name")


@query("""SELECT p_partkey, b.band FROM part JOIN (VALUES (0, 950, 'low'), (950, 1200, 'middle'), (1200, 1e9, 'high')) b(lo, hi, band) ON p_retailprice >= lo AND p_retailprice < hi""")
def join_band(spark, sf_dir):
    """A theta join with a three-row table of price bands."""
    bands = spark.createDataFrame([(0.0, 950.0, "low"), (950.0, 1200.0, "middle"), (1200.0, 1e9, "high")], "lo double, hi double, band string")
    p = table(spark, sf_dir, "part")
    return p.join(F.broadcast(bands), (F.col("p_retailprice") >= F.col("lo")) & (F.col("p_retailprice") < F.col("hi"))).select("p_partkey", "band")


@query("""SELECT a.o_orderkey, b.o_orderkey AS next_orderkey FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND b.o_orderdate > a.o_orderdate AND b.o_orderdate <= a.o_orderdate + INTERVAL 14 DAY""")
def join_within_days(spark, sf_dir):
    """Orders of one customer at most two weeks apart: an equi-join with a range in it."""
    o = table(spark, sf_dir, "orders")
    a, b = o.select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("d")), o.select(F.col("o_orderkey").alias("next_orderkey"), "o_custkey", F.col("o_orderdate").alias("e"))
    return a.join(b, "o_custkey").where("e > d and e <= d + interval 14 days").select("o_orderkey", "next_orderkey")


@query("""SELECT r_name, n_name, count(*) AS n, round(sum(c_acctbal), 2) AS balance, CAST(grouping(r_name) * 2 + grouping(n_name) AS BIGINT) AS level
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)""")
def rollup_region_nation(spark, sf_dir):
    c, n, r = t(spark, sf_dir, "customer", "nation", "region")
    d = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return d.rollup("r_name", "n_name").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"), F.grouping_id().cast("long").alias("level"))


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def cube_flags(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query("""SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())""")
def grouping_sets(spark, sf_dir):
    table(spark, sf_dir, "orders").createOrReplaceTempView("_grouped_orders")
    return spark.sql("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM _grouped_orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")


@query("""SELECT o_orderstatus, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent, count(*) FILTER (o_orderpriority = '5-LOW') AS low, round(avg(o_totalprice) FILTER (o_orderpriority = '1-URGENT'), 4) AS urgent_mean FROM orders GROUP BY 1""")
def status_counts(spark, sf_dir):
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count_if(urgent).alias("urgent"), F.count_if(F.col("o_orderpriority") == "5-LOW").alias("low"), F.round(F.avg(F.when(urgent, F.col("o_totalprice"))), 4).alias("urgent_mean"))


@query("""SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'P') AS p FROM orders GROUP BY 1""")
def pivot_status(spark, sf_dir):
    d = table(spark, sf_dir, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count()
    return d.select("o_orderpriority", *(F.coalesce(c, F.lit(0)).alias(c.lower()) for c in "FOP"))


@query("""SELECT s_suppkey, kind, v FROM (SELECT s_suppkey, 'balance' AS kind, s_acctbal AS v FROM supplier UNION ALL SELECT s_suppkey, 'nation', CAST(s_nationkey AS DOUBLE) FROM supplier)""")
def unpivot_supplier(spark, sf_dir):
    d = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_acctbal").alias("balance"), F.col("s_nationkey").cast("double").alias("nation"))
    return d.unpivot("s_suppkey", ["balance", "nation"], "kind", "v")


@query("""WITH r AS (SELECT c_mktsegment, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY c_mktsegment ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT c_mktsegment, o_orderkey, o_totalprice, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3""")
def top3_per_group(spark, sf_dir):
    o, c = t(spark, sf_dir, "orders", "customer")
    d = o.join(c, o.o_custkey == c.c_custkey).select("c_mktsegment", "o_orderkey", "o_totalprice")
    return sampling.top_per(d, ["c_mktsegment"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("""WITH r AS (SELECT c_mktsegment, c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey) AS k FROM customer) SELECT c_mktsegment, c_custkey FROM r WHERE k <= 5""")
def stratified_sample(spark, sf_dir):
    d = table(spark, sf_dir, "customer").select("c_mktsegment", "c_custkey")
    return sampling.stratified(d, ["c_mktsegment"], "c_custkey", 5, F.md5(F.col("c_custkey").cast("string"))).select("c_mktsegment", "c_custkey")


@query("""WITH r AS (SELECT c_mktsegment, c_custkey, c_acctbal, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS turn FROM customer WHERE c_acctbal > 0),
s AS (SELECT *, sum(c_acctbal) OVER (ORDER BY turn, c_mktsegment) AS spent FROM r)
SELECT c_mktsegment, c_custkey, turn, round(spent, 2) AS spent FROM s WHERE spent - c_acctbal < 100000""")
def round_robin_until(spark, sf_dir):
    """The first of every segment, then the second, until a total is reached.

    Totals per turn come first, so only turns up to the cap (few rows) are
    ordered in one place."""
    d = sampling.round_robin(table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_mktsegment", "c_custkey", "c_acctbal"), "c_mktsegment", [F.col("c_custkey")])
    per_turn = d.groupBy("turn").agg(F.sum("c_acctbal").alias("a"))
    before = per_turn.withColumn("b", F.sum("a").over(Window.orderBy("turn")) - F.col("a")).where("b < 100000").select("turn", "b")
    w = Window.partitionBy("turn").orderBy("c_mktsegment")
    out = d.join(F.broadcast(before), "turn").withColumn("spent", F.col("b") + F.sum("c_acctbal").over(w))
    return out.where("spent - c_acctbal < 100000").select("c_mktsegment", "c_custkey", F.col("turn").cast("long").alias("turn"), F.round("spent", 2).alias("spent"))


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def set_union(spark, sf_dir):
    c, s = t(spark, sf_dir, "customer", "supplier")
    return c.select(F.col("c_nationkey").alias("k")).union(s.select("s_nationkey")).distinct()


@query("SELECT c_nationkey AS k FROM customer WHERE c_acctbal < 0 INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal < 0")
def set_intersect(spark, sf_dir):
    c, s = t(spark, sf_dir, "customer", "supplier")
    return c.where("c_acctbal < 0").select(F.col("c_nationkey").alias("k")).intersect(s.where("s_acctbal < 0").select("s_nationkey"))


@query("SELECT p_size AS k FROM part EXCEPT ALL SELECT p_size FROM part WHERE p_retailprice > 1000")
def set_except_all(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_size").alias("k")).exceptAll(p.where("p_retailprice > 1000").select("p_size"))


@query("SELECT DISTINCT p_brand, p_size FROM part")
def distinct_rows(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_brand", "p_size").distinct()


@query("""WITH s AS (SELECT l_suppkey, sum(l_extendedprice * (1 - l_discount)) AS revenue FROM lineitem GROUP BY 1)
SELECT l_suppkey, round(revenue, 2) AS revenue, CAST(ntile(10) OVER (ORDER BY revenue DESC, l_suppkey) AS INTEGER) AS decile, round(revenue / sum(revenue) OVER (), 9) AS share FROM s""")
def revenue_deciles(spark, sf_dir):
    """Shares and deciles of suppliers by their places in a table cut into ranges."""
    s = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    d = places.placed(s, [F.desc("revenue"), F.col("l_suppkey")])
    whole = F.broadcast(d.agg(F.count("*").alias("n"), F.sum("revenue").alias("all")))
    return d.join(whole).select("l_suppkey", F.round("revenue", 2).alias("revenue"), places.tile(F.col("place"), F.col("n"), 10).alias("decile"), F.round(F.col("revenue") / F.col("all"), 9).alias("share"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS place, round(sum(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey), 2) AS so_far FROM orders")
def running_revenue(spark, sf_dir):
    """Every order's place in time and the revenue up to it, over the whole table."""
    d = places.placed(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"], {"so_far": "o_totalprice"})
    return d.select("o_orderkey", "place", F.round("so_far", 2).alias("so_far"))


@query("""WITH RECURSIVE c(k, depth) AS (SELECT r_regionkey, 0 FROM region WHERE r_regionkey = 0 UNION ALL SELECT k + 1, depth + 1 FROM c WHERE k < 4) SELECT CAST(k AS BIGINT) AS k, CAST(depth AS BIGINT) AS depth, r_name FROM c JOIN region ON k = r_regionkey""")
def follow_map(spark, sf_dir):
    """Follow a chain (each region to the next) by a recursive query."""
    table(spark, sf_dir, "region").createOrReplaceTempView("_chain")
    return spark.sql("""WITH RECURSIVE c(k, depth) AS (SELECT r_regionkey, 0 FROM _chain WHERE r_regionkey = 0 UNION ALL SELECT k + 1, depth + 1 FROM c WHERE k < 4)
      SELECT CAST(k AS BIGINT) AS k, CAST(depth AS BIGINT) AS depth, r_name FROM c JOIN _chain ON k = r_regionkey""")


@query("""WITH a AS (SELECT o_custkey, o_orderkey, o_orderdate, lag(o_orderdate) OVER w AS was, o_totalprice - lag(o_totalprice) OVER w AS change, rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS rank, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS level, first_value(o_orderkey) OVER w AS first_order FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
SELECT o_custkey, o_orderkey, CAST(date_diff('day', CAST(was AS DATE), CAST(o_orderdate AS DATE)) AS INTEGER) AS days_since, round(change, 2) AS change, CAST(rank AS INTEGER) AS rank, CAST(level AS INTEGER) AS level, first_order FROM a""")
def order_history(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return o.select(
        "o_custkey", "o_orderkey", F.datediff("o_orderdate", F.lag("o_orderdate").over(w)).alias("days_since"), F.round(F.col("o_totalprice") - F.lag("o_totalprice").over(w), 2).alias("change"),
        F.rank().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"))).alias("rank"), F.dense_rank().over(Window.partitionBy("o_custkey").orderBy("o_orderpriority")).alias("level"),
        F.first("o_orderkey").over(w).alias("first_order"),
    )

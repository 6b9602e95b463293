"""Scores of orders and customers against their peers, and comparisons of runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.operators import checks, compare, records, scores
from spanloom.plans.registry import query, table


def order_values(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice", F.concat_ws("/", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("grp"))


@query("""WITH o AS (SELECT o_orderkey, o_totalprice, c_mktsegment || '/' || c_nationkey AS grp FROM orders JOIN customer ON o_custkey = c_custkey),
m AS (SELECT a.o_orderkey, count(b.o_orderkey) AS peers, quantile_cont(b.o_totalprice, 0.5) AS peer_median FROM o a LEFT JOIN o b ON a.grp = b.grp AND a.o_orderkey <> b.o_orderkey GROUP BY 1)
SELECT o.o_orderkey, grp, peers, round(peer_median, 4) AS peer_median, round(CASE WHEN peers >= 5 AND o_totalprice > 0 THEN least(10.0, greatest(0.0, 10 * peer_median / o_totalprice)) END, 6) AS score FROM o JOIN m USING (o_orderkey)""")
def peer_ratio_score(spark, sf_dir):
    d = scores.leave_one_out_median(order_values(spark, sf_dir), ["grp"], "o_totalprice", "o_orderkey")
    return d.select("o_orderkey", "grp", "peers", F.round("peer_median", 4).alias("peer_median"), F.round(scores.ratio_score(F.col("o_totalprice"), F.col("peer_median"), F.col("peers")), 6).alias("score"))


@query("""WITH l AS (SELECT l_orderkey, avg(CASE WHEN l_returnflag = 'R' THEN 0.0 WHEN l_returnflag = 'A' THEN 10.0 END) AS kept, avg(10 - 100 * l_discount) AS price, CASE WHEN count(*) >= 3 THEN least(10.0, count(*)) END AS size FROM lineitem GROUP BY 1),
w AS (SELECT *, (CASE WHEN kept IS NULL THEN 0 ELSE 0.75 END + CASE WHEN price IS NULL THEN 0 ELSE 0.10 END + CASE WHEN size IS NULL THEN 0 ELSE 0.15 END) AS total FROM l)
SELECT l_orderkey, round((coalesce(kept * 0.75, 0) + coalesce(price * 0.10, 0) + coalesce(size * 0.15, 0)) / total, 6) AS score FROM w WHERE total > 0""")
def weighted_score(spark, sf_dir):
    """A weighted mean over the parts that an order has."""
    flag = F.when(F.col("l_returnflag") == "R", 0.0).when(F.col("l_returnflag") == "A", 10.0)
    d = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.avg(flag).alias("kept"), F.avg(10 - 100 * F.col("l_discount")).alias("price"), F.when(F.count("*") >= 3, F.least(F.lit(10.0), F.count("*").cast("double"))).alias("size"))
    return d.select("l_orderkey", F.round(scores.weighted({"kept": 0.75, "price": 0.10, "size": 0.15}), 6).alias("score"))


@query("""WITH m AS (SELECT l_orderkey, CASE WHEN l_quantity > 40 THEN 'high' WHEN l_quantity > 25 THEN 'medium' WHEN l_quantity > 10 THEN 'low' END AS severity, l_linestatus = 'F' AS recovered FROM lineitem),
p AS (SELECT *, CASE severity WHEN 'low' THEN 0.5 WHEN 'medium' THEN 1.5 WHEN 'high' THEN 3.0 END * CASE WHEN recovered THEN 0.5 ELSE 1 END AS points FROM m)
SELECT l_orderkey, CAST(round(greatest(0.0, 10 - coalesce(sum(points), 0)), 6) AS DOUBLE) AS cleanliness, count(*) FILTER (severity IS NULL) AS unrated FROM p GROUP BY 1""")
def cleanliness_score(spark, sf_dir):
    q = F.col("l_quantity")
    severity = F.when(q > 40, "high").when(q > 25, "medium").when(q > 10, "low")
    d = table(spark, sf_dir, "lineitem").select("l_orderkey", severity.alias("severity"), (F.col("l_linestatus") == "F").alias("recovered"))
    d = d.withColumn("points", scores.penalties(F.col("severity"), F.col("recovered")))
    return d.groupBy("l_orderkey").agg(F.round(F.greatest(F.lit(0.0), 10 - F.coalesce(F.sum("points"), F.lit(0.0))), 6).alias("cleanliness"), F.count_if(F.col("severity").isNull()).alias("unrated"))


def by_run(spark, sf_dir):
    """Users as items, event types as runs that measure them."""
    return table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.avg("value").alias("m"), F.count("*").alias("n"))


RUNS = "WITH r AS (SELECT event_type, user_id, avg(value) AS m, count(*) AS n FROM events GROUP BY 1, 2)"


@query(RUNS + """, c AS (SELECT user_id FROM r GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT event_type) FROM r))
SELECT event_type, count(*) AS items, round(avg(m), 6) AS mean, sum(n) AS events FROM r JOIN c USING (user_id) GROUP BY 1""")
def common_means(spark, sf_dir):
    d = compare.common(by_run(spark, sf_dir), "event_type", "user_id")
    return d.groupBy("event_type").agg(F.count("*").alias("items"), F.round(F.avg("m"), 6).alias("mean"), F.sum("n").alias("events"))


@query(RUNS + """, g AS (SELECT event_type, user_id, m > 100 AS high FROM r)
SELECT a.event_type AS a, b.event_type AS b, count(*) AS n, count(*) FILTER (a.high = b.high) AS same, round(count(*) FILTER (a.high = b.high) / count(*), 9) AS share FROM g a JOIN g b ON a.user_id = b.user_id AND a.event_type < b.event_type GROUP BY 1, 2""")
def agreement(spark, sf_dir):
    d = by_run(spark, sf_dir).withColumn("high", F.col("m") > 100)
    return compare.agreement(d, "event_type", "user_id", "high").withColumn("share", F.round("share", 9))


@query("""WITH s AS (SELECT user_id, list_sort(list(DISTINCT event_id % 7) FILTER (event_type = 'view')) AS a, list_sort(list(DISTINCT event_id % 7) FILTER (event_type = 'purchase')) AS b FROM events GROUP BY 1),
n AS (SELECT user_id, len(list_intersect(coalesce(a, []), coalesce(b, []))) AS i, len(list_distinct(list_concat(coalesce(a, []), coalesce(b, [])))) AS u FROM s)
SELECT count(*) AS items, CAST(sum(i) AS BIGINT) AS shared, CAST(sum(u) AS BIGINT) AS "all", round(sum(i) / sum(u), 9) AS jaccard FROM n""")
def micro_jaccard(spark, sf_dir):
    key = F.col("event_id") % 7
    d = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set(F.when(F.col("event_type") == "view", key)).alias("a"), F.collect_set(F.when(F.col("event_type") == "purchase", key)).alias("b"))
    return compare.micro_jaccard(d, "user_id", "a", "b").withColumn("jaccard", F.round("jaccard", 9))


@query(RUNS + """, p AS (SELECT user_id, max(m) FILTER (event_type = 'view') AS a, max(m) FILTER (event_type = 'purchase') AS b FROM r GROUP BY 1), d AS (SELECT user_id, b - a AS d FROM p WHERE a IS NOT NULL AND b IS NOT NULL),
x AS (SELECT user_id, d, k, CAST('0x' || substr(md5('1-' || k || '-' || user_id), 1, 8) AS BIGINT) / 4294967296.0 AS u FROM d, range(0, 500) t(k)),
w AS (SELECT k, sum(w) AS w, sum(w * d) AS s FROM (SELECT *, """ + " + ".join(f"CAST(u >= CAST({c!r} AS DOUBLE) AS INTEGER)" for c in compare.poisson_cuts()) + """ AS w FROM x) GROUP BY 1 HAVING sum(w) > 0), m AS (SELECT list_sort(list(s / w)) AS m FROM w),
b AS (SELECT m[greatest(1, least(len(m), CAST(floor(len(m) * 0.025) AS INTEGER) + 1))] AS low, m[greatest(1, least(len(m), CAST(floor(len(m) * 0.975) AS INTEGER) + 1))] AS high FROM m), t AS (SELECT avg(d) AS difference, count(*) AS items FROM d)
SELECT round(difference, 6) AS difference, items, round(low, 6) AS low, round(high, 6) AS high, CASE WHEN low > 0 THEN 'gain' WHEN high < 0 THEN 'drop' ELSE 'same' END AS verdict FROM t, b""")
def paired_bootstrap(spark, sf_dir):
    """Views against purchases of the same users."""
    d = by_run(spark, sf_dir).groupBy("user_id").pivot("event_type", ["view", "purchase"]).agg(F.first("m"))
    out = compare.paired_bootstrap(d, "user_id", "view", "purchase", draws=500)
    return out.select(F.round("difference", 6).alias("difference"), "items", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "verdict")


@query("""WITH i AS (SELECT l_orderkey, l_linenumber, l_shipdate, CASE WHEN l_quantity > 40 THEN 'high' WHEN l_quantity > 20 THEN 'medium' WHEN l_quantity > 5 THEN 'low' END AS s, l_returnflag, l_linestatus, l_discount FROM lineitem)
SELECT l_orderkey, l_linenumber, s AS given_severity,
  CASE WHEN l_linestatus = 'F' AND (CASE WHEN l_returnflag = 'R' AND s = 'high' THEN 'medium' ELSE s END) IN ('medium', 'high') THEN 'low' WHEN l_returnflag = 'R' AND s = 'high' THEN 'medium' ELSE s END AS severity,
  l_discount >= 0.1 AS excluded,
  list_filter([CASE WHEN l_returnflag = 'R' THEN 0 END, CASE WHEN l_linestatus = 'F' THEN 1 END, CASE WHEN l_discount >= 0.1 THEN 2 END], lambda x: x IS NOT NULL)::VARCHAR AS rules FROM i""")
def severity_rules(spark, sf_dir):
    q = F.col("l_quantity")
    d = table(spark, sf_dir, "lineitem").withColumn("severity", F.when(q > 40, "high").when(q > 20, "medium").when(q > 5, "low"))
    rules = [("cap", F.col("l_returnflag") == "R", "medium"), ("cap", F.col("l_linestatus") == "F", "low"), ("exclude", F.col("l_discount") >= 0.1, None)]
    out = records.apply_rules(d, "severity", rules)
    return out.select("l_orderkey", "l_linenumber", "given_severity", "severity", "excluded", F.concat(F.lit("["), F.array_join("rules", ", "), F.lit("]")).alias("rules"))


CHECKS = lambda: [
    checks.Check("has_orders", 1, F.lit(True), F.col("n") == 0, F.col("n")),
    checks.Check("late_mean", 2, F.col("n") > 0, F.col("mean") > 160000, F.col("mean")),
    checks.Check("balance", 1, F.col("c_acctbal").isNotNull(), F.col("c_acctbal") < 0, F.col("c_acctbal")),
]


def check_input(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.avg("o_totalprice").alias("mean"))
    c = table(spark, sf_dir, "customer")
    return c.join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", "c_acctbal", F.coalesce("n", F.lit(0)).alias("n"), "mean")


CHECKED = """WITH i AS (SELECT c_custkey, c_acctbal, count(o_orderkey) AS n, avg(o_totalprice) AS mean FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2),
r AS (SELECT c_custkey, 'has_orders' AS "check", 1 AS version, CASE WHEN n = 0 THEN 'fired' ELSE 'clear' END AS status, CAST(n AS DOUBLE) AS value FROM i
 UNION ALL SELECT c_custkey, 'late_mean', 2, CASE WHEN n = 0 THEN 'not_applicable' WHEN mean > 160000 THEN 'fired' ELSE 'clear' END, mean FROM i
 UNION ALL SELECT c_custkey, 'balance', 1, CASE WHEN c_acctbal < 0 THEN 'fired' ELSE 'clear' END, c_acctbal FROM i)"""


@query(CHECKED + ' SELECT c_custkey, "check", version, status, round(value, 4) AS value FROM r')
def check_registry(spark, sf_dir):
    return checks.run_checks(check_input(spark, sf_dir), ["c_custkey"], CHECKS()).withColumn("value", F.round("value", 4))


@query(CHECKED + """ SELECT c_custkey, count(*) FILTER (status = 'fired') AS fired, count(*) FILTER (status = 'clear') AS clear, count(*) FILTER (status = 'not_applicable') AS not_applicable, count(*) FILTER (status = 'errored') AS errored,
  CASE WHEN count(*) FILTER (status = 'fired') > 0 THEN 'fired' ELSE 'clear' END AS worst FROM r GROUP BY 1""")
def check_rollup(spark, sf_dir):
    return checks.rollup(checks.run_checks(check_input(spark, sf_dir), ["c_custkey"], CHECKS()), ["c_custkey"])


@query("SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0")
def stale_checks(spark, sf_dir):
    """Results of a third of the customers have an older version of one check."""
    done = checks.run_checks(check_input(spark, sf_dir), ["c_custkey"], CHECKS())
    older = done.withColumn("version", F.when((F.col("check") == "late_mean") & (F.col("c_custkey") % 3 == 0), 1).otherwise(F.col("version")))
    return checks.stale(older, ["c_custkey"], CHECKS())


@query("""SELECT c_custkey, coalesce(CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END, CASE WHEN c_custkey % 2 = 0 THEN 'EDITED' END) AS segment, CASE WHEN c_custkey % 4 = 2 THEN '[segment]' ELSE '[]' END AS conflicts FROM customer""")
def overlay_edits(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    base = c.select("c_custkey", F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("segment"))
    edits = c.where("c_custkey % 2 = 0").select("c_custkey", F.lit("EDITED").alias("segment"))
    out = records.overlay(base, edits, "c_custkey", ["segment"])
    return out.select("c_custkey", "segment", F.concat(F.lit("["), F.array_join("conflicts", ", "), F.lit("]")).alias("conflicts"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'new' WHEN c_custkey % 7 = 0 THEN 'changed' ELSE 'same' END AS state FROM customer""")
def incremental_state(spark, sf_dir):
    """What an incremental run redoes, by content digest."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.sha2(F.concat_ws("|", "c_name", "c_mktsegment"), 256).alias("digest"))
    before = c.where("c_custkey % 5 <> 0").withColumn("digest", F.when(F.col("c_custkey") % 7 == 0, F.lit("old")).otherwise(F.col("digest")))
    return records.changed(c, before, "c_custkey", "digest").select("c_custkey", "state")


@query("""SELECT p_brand, CAST(count(*) AS BIGINT) AS surplus FROM part WHERE p_size > 45 GROUP BY 1""")
def multiset_difference(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return records.same_multiset(p.select("p_brand"), p.where("p_size <= 45").select("p_brand"))

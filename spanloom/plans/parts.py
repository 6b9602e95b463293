"""Queries over recordings in parts, merge maps, claims and what texts assert."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from spanloom.functions import text as tx
from spanloom.operators import intervals, parts
from spanloom.operators.places import placed
from spanloom.plans.registry import EVENTS, query, table, timed_events

PART, OVERLAP = 432000.0, 43200.0


@query(EVENTS + """, n AS (SELECT max(CAST(floor(t / 432000) AS BIGINT)) AS last FROM ev), p AS (SELECT unnest(range(0, last + 1)) AS part, last FROM n),
i AS (SELECT user_id, event_id, part, last, greatest(t, part * 432000.0 - 43200) AS s, least(t + value * 100, (part + 1) * 432000.0 + 43200) AS e FROM ev JOIN p ON t < (part + 1) * 432000.0 + 43200 AND t + value * 100 > part * 432000.0 - 43200),
c AS (SELECT *, greatest(s, CASE WHEN part > 0 THEN part * 432000.0 END) AS a, least(e, CASE WHEN part < last THEN (part + 1) * 432000.0 END) AS b FROM i)
SELECT user_id, event_id, part, round(a, 3) AS s, round(b, 3) AS e, (a <> s OR b <> e) AS clipped, CASE WHEN b >= (part + 1) * 432000.0 - 1 AND part < last THEN 'unclear' ELSE 'partial' END AS outcome FROM c WHERE a < b""")
def window_copies(spark, sf_dir):
    """Spans labelled by each part of five days that sees them (half a day beyond its cuts): every
    moment is kept once, from the part on its own side of the cut; what is open at a cut is unclear."""
    ev = timed_events(spark, sf_dir).select("user_id", "event_id", F.col("t").alias("s"), (F.col("t") + F.col("value") * 100).alias("e"))
    last = ev.agg(F.max(F.floor(F.col("s") / PART)).alias("last"))
    # A span meets the parts between the places of its ends.
    at = lambda x, by: F.floor((x + by) / PART)
    seen = ev.join(F.broadcast(last)).withColumn("part", F.explode(F.sequence(F.greatest(F.lit(0).cast("long"), at(F.col("s"), -OVERLAP)), F.least(F.col("last"), at(F.col("e"), OVERLAP)))))
    seen = intervals.clip(seen, F.col("part") * PART - OVERLAP, (F.col("part") + 1) * PART + OVERLAP)
    d = parts.own_half(seen, F.when(F.col("part") > 0, F.col("part") * PART), F.when(F.col("part") < F.col("last"), (F.col("part") + 1) * PART))
    outcome = parts.open_at_cut(F.lit("partial"), F.col("e"), F.when(F.col("part") < F.col("last"), (F.col("part") + 1) * PART), 1.0)
    return d.select("user_id", "event_id", "part", F.round("s", 3).alias("s"), F.round("e", 3).alias("e"), "clipped", outcome.alias("outcome"))


def readings(spark, sf_dir):
    """Each turn as a part's reading of its conversation, made from its text."""
    n = F.length("text")
    names = F.array(*map(F.lit, ["narrower", "aligned", "broader", "different", "unrelated"]))
    words = F.array(*map(F.lit, ["success", "success", "partial", "failure", "success_then_undone"]))
    c = table(spark, sf_dir, "conversations")
    relation = F.when(n % 11 == 0, F.element_at(names, (n % 2 + 4).cast("int"))).otherwise(F.element_at(names, (n % 3 + 1).cast("int")))
    return c.select("conv_id", "turn", relation.alias("relation"), (n % 7 > 0).alias("matches"), F.when(n % 13 > 0, F.element_at(words, (n % 5 + 1).cast("int"))).alias("outcome"), (F.col("turn") * 100 + n % 50).alias("done"), F.count("*").over(Window.partitionBy("conv_id")).alias("parts"))


READINGS = """WITH r AS (SELECT conv_id, turn, CASE WHEN length(text) % 11 = 0 THEN ['different', 'unrelated'][length(text) % 2 + 1] ELSE ['narrower', 'aligned', 'broader'][length(text) % 3 + 1] END AS relation, length(text) % 7 > 0 AS matches,
  CASE WHEN length(text) % 13 > 0 THEN ['success', 'success', 'partial', 'failure', 'success_then_undone'][length(text) % 5 + 1] END AS outcome, turn * 100 + length(text) % 50 AS done, count(*) OVER (PARTITION BY conv_id) AS parts FROM conversations)"""


@query(READINGS + """, g AS (SELECT conv_id, bool_or(relation = 'unrelated' AND NOT matches) AS u, bool_or(relation = 'different' AND NOT matches) AS d, bool_and(relation IN ('narrower', 'aligned', 'broader') AND matches) AS ok, bool_or(relation = 'narrower') AS n, bool_or(relation = 'aligned') AS a FROM r GROUP BY 1)
SELECT conv_id, CASE WHEN u THEN 'unrelated' WHEN d THEN 'different' WHEN ok THEN CASE WHEN n THEN 'narrower' WHEN a THEN 'aligned' ELSE 'broader' END END AS relation, CASE WHEN u OR d THEN false WHEN ok THEN true END AS matches FROM g""")
def parts_goal_alignment(spark, sf_dir):
    return parts.goal_alignment(readings(spark, sf_dir), "conv_id", "relation", "matches", "parts")


@query(READINGS + """, w AS (SELECT *, sum(CASE WHEN outcome IS NOT DISTINCT FROM 'success' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn DESC) AS gap, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM r),
g AS (SELECT conv_id, max(outcome) FILTER (back = 1) AS last, bool_or(outcome IS NULL) AS silent, coalesce(bool_or(outcome IN ('success', 'success_then_undone')), false) AS reached, min(done) FILTER (gap = 0) AS done FROM w GROUP BY 1),
o AS (SELECT conv_id, CASE WHEN silent OR (last NOT IN ('success', 'success_then_undone') AND reached) THEN 'unclear' ELSE last END AS outcome, done FROM g)
SELECT conv_id, outcome, CASE WHEN outcome = 'success' THEN done END AS done_at FROM o""")
def parts_goal_outcome(spark, sf_dir):
    return parts.goal_outcome(readings(spark, sf_dir), "conv_id", "turn", "outcome", "done")


@query(READINGS + """, s AS (SELECT conv_id, 10 * CASE WHEN outcome = 'success' THEN 1.0 WHEN outcome IN ('partial', 'failure', 'success_then_undone') THEN least(CASE outcome WHEN 'partial' THEN 0.9 WHEN 'failure' THEN 0.4 ELSE 0.7 END, (done % 100) / 50) END AS score FROM r)
SELECT conv_id, round(avg(score), 6) AS score, count(score) AS judged FROM s GROUP BY 1""")
def outcome_score(spark, sf_dir):
    s = readings(spark, sf_dir).withColumn("score", parts.outcome_score(F.col("outcome"), F.col("done") % 100 / 50))
    return s.groupBy("conv_id").agg(F.round(F.avg("score"), 6).alias("score"), F.count("score").alias("judged"))


@query(EVENTS + """, g AS (SELECT user_id, t, event_type, value, coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stretch FROM ev),
b AS (SELECT user_id, stretch, min(t) AS a, max(t) AS z, count(*) FILTER (event_type = 'click') AS attempts, bool_or(event_type = 'purchase') AS reached FROM g GROUP BY 1, 2),
c AS (SELECT *, coalesce(lag(z) OVER (PARTITION BY user_id ORDER BY stretch), a) AS s FROM b)
SELECT user_id, CAST(stretch AS BIGINT) AS stretch, round(z - s, 3) AS seconds, attempts, reached FROM c""")
def subgoal_stretches(spark, sf_dir):
    """The stretches of a user's events that end in a purchase, and a last one that doesn't."""
    d = parts.stretches(timed_events(spark, sf_dir), ["user_id"], "t", F.col("event_type") == "purchase")
    b = d.groupBy("user_id", "stretch").agg(F.min("t").alias("a"), F.max("t").alias("z"), F.count_if(F.col("event_type") == "click").alias("attempts"), F.bool_or(F.col("event_type") == "purchase").alias("reached"))
    begin = F.coalesce(F.lag("z").over(Window.partitionBy("user_id").orderBy("stretch")), F.col("a"))
    return b.withColumn("s", begin).select("user_id", F.col("stretch").cast("long").alias("stretch"), F.round(F.col("z") - F.col("s"), 3).alias("seconds"), "attempts", "reached")


@query("""WITH p AS (SELECT p_brand, p_partkey, p_retailprice, list_distinct(string_split(p_name, ' ')) AS w FROM part),
m AS (SELECT a.p_partkey, b.p_retailprice FROM p a JOIN p b ON a.p_brand = b.p_brand AND a.p_partkey <> b.p_partkey WHERE len(list_intersect(a.w, b.w)) >= 0.3 * (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))))
SELECT p_partkey, count(*) AS peers, round(quantile_cont(p_retailprice, 0.5), 4) AS peer_median FROM m GROUP BY 1""")
def similar_pools(spark, sf_dir):
    """Of each part the others of its brand with a like name, and their median price.

    Names of one word set stand together, and so do parts of one name and price, so pairs are of
    names and a pool holds prices with their counts.  Pools are ranked in ranges of all their
    prices, however many parts one has; a part's own rank says which of the pool's middle
    prices are the middle of the others.
    """
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice", F.array_sort(F.array_distinct(F.split("p_name", " "))).alias("w"))
    names = p.select("p_brand", "w").distinct()
    one = names.select("p_brand", F.col("w").alias("a"), F.explode("w").alias("x"))
    two = names.select("p_brand", F.col("w").alias("b"), F.explode("w").alias("x"))
    met = one.join(two, ["p_brand", "x"]).groupBy("p_brand", "a", "b").agg(F.count("*").alias("i"))
    like = met.where(F.col("i") >= 0.3 * (F.size("a") + F.size("b") - F.col("i"))).select("p_brand", "a", "b")
    prices = p.groupBy("p_brand", "w", "p_retailprice").agg(F.count("*").alias("n"))
    pool = like.join(prices.withColumnRenamed("w", "b"), ["p_brand", "b"]).groupBy("p_brand", "a", "p_retailprice").agg(F.sum("n").alias("n"), F.bool_or(F.col("a") == F.col("b")).alias("own"))
    pool = placed(pool, ["p_brand", "a", "p_retailprice"], {"upto": "n"})
    whole = pool.groupBy("p_brand", "a").agg(F.min(F.col("upto") - F.col("n")).alias("start"), F.sum("n").alias("all"))
    first, last = F.col("upto") - F.col("n") - F.col("start") + 1, F.col("upto") - F.col("start")
    pool = pool.join(whole.where(F.col("all") > 1), ["p_brand", "a"]).withColumns({"first": first.cast("long"), "last": last.cast("long")})
    # Of all - 1 others the middle ones are lo and hi; a part at or before them moves them on by one.
    lo, hi = F.floor(F.col("all") / 2), F.floor((F.col("all") - 1) / 2) + 1
    at = lambda k: F.max(F.when(k.between(F.col("first"), F.col("last")), F.col("p_retailprice")))
    middle = pool.groupBy("p_brand", "a", "all").agg(at(lo).alias("l0"), at(lo + 1).alias("l1"), at(hi).alias("h0"), at(hi + 1).alias("h1")).drop("all")
    d = pool.where("own").join(middle, ["p_brand", "a"])
    median = (F.when(F.col("first") <= lo, F.col("l1")).otherwise(F.col("l0")) + F.when(F.col("first") <= hi, F.col("h1")).otherwise(F.col("h0"))) / 2
    d = d.select("p_brand", F.col("a").alias("w"), F.col("p_retailprice").alias("price"), (F.col("all") - 1).alias("peers"), F.round(median, 4).alias("peer_median"))
    same = (p["p_brand"] == d["p_brand"]) & (p["w"] == d["w"]) & p["p_retailprice"].eqNullSafe(d["price"])
    return p.join(d, same).select("p_partkey", "peers", "peer_median")


@query("""SELECT l_orderkey, CASE WHEN count(DISTINCT l_returnflag) = 1 THEN min(l_returnflag) END AS l_returnflag, count(DISTINCT l_returnflag) AS claims FROM lineitem GROUP BY 1""")
def resolved_labels(spark, sf_dir):
    """One label for each order where its lines agree; a conflict keeps none."""
    return parts.agreed(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_returnflag")


@query("""WITH RECURSIVE n AS (SELECT count(*) AS n FROM customer), m AS (SELECT c_custkey AS node, (c_custkey * 7 + 3) % n AS dest FROM customer, n WHERE c_custkey % 5 > 0 AND (c_custkey * 7 + 3) % n <> c_custkey),
f(node, now, path) AS (SELECT node, dest, [node] FROM m UNION ALL SELECT f.node, m.dest, list_append(f.path, f.now) FROM f JOIN m ON f.now = m.node WHERE NOT list_contains(f.path, f.now))
SELECT node, arg_max(now, len(path)) AS root FROM f GROUP BY 1""")
def merge_roots(spark, sf_dir):
    """Follow a merge map of customers to its roots; some chains run into circles."""
    c = table(spark, sf_dir, "customer")
    n = c.count()
    return parts.roots(c.where("c_custkey % 5 > 0").select(F.col("c_custkey").alias("node"), ((F.col("c_custkey") * 7 + 3) % n).alias("to")))


FAMILIES = {"insult": " (pathetic|worthless|loser|scum|disgusting) ", "place": " (here|there|where) ", "doubt": " (perhaps|maybe|que) "}
SAID = "WITH s AS (SELECT doc_id, source, text, list_transform(string_split_regex(lower(text), '" + tx.CLAUSE_ENDS + "'), lambda c: regexp_replace(' ' || trim(regexp_replace(c, '[^a-z0-9]+', ' ', 'g')) || ' ', ' (" + "|".join(tx.DENIALS) + ") .*$', ' ')) AS said, ' ' || trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) || ' ' AS whole FROM documents)"


@query(SAID + ", f AS (" + " UNION ALL ".join(f"SELECT doc_id, source, '{k}' AS family, len(list_filter(said, lambda c: regexp_matches(c, '{v}'))) > 0 AS said, regexp_matches(whole, '{v}') AS named FROM s" for k, v in FAMILIES.items()) + ") SELECT source, family, count(*) FILTER (said) AS asserted, count(*) FILTER (named AND NOT said) AS denied FROM f GROUP BY 1, 2")
def asserted_families(spark, sf_dir):
    """Documents of each source that assert a family's words, and those that only deny them."""
    d = table(spark, sf_dir, "documents").select("source", "text", F.concat(F.lit(" "), tx.plain(F.col("text")), F.lit(" ")).alias("whole"))
    # Only a text that names a family is read clause by clause.
    d = d.withColumn("said", F.when(F.col("whole").rlike("|".join(FAMILIES.values())), tx.said(F.col("text"))))
    says = lambda v: F.coalesce(F.exists("said", lambda c: c.rlike(v)), F.lit(False))
    found = F.array(*(F.struct(F.lit(k).alias("family"), says(v).alias("said"), F.col("whole").rlike(v).alias("named")) for k, v in FAMILIES.items()))
    f = d.select("source", F.explode(found).alias("f"))
    return f.groupBy("source", F.col("f.family").alias("family")).agg(F.count_if("f.said").alias("asserted"), F.count_if(F.col("f.named") & ~F.col("f.said")).alias("denied"))


@query(EVENTS + """, f AS (SELECT user_id, t, row_number() OVER (PARTITION BY user_id ORDER BY t) - 1 AS k FROM ev), c AS (SELECT user_id, min(k) AS cut FROM f WHERE t >= 432000 GROUP BY user_id, floor(t / 432000)),
x AS (SELECT c.user_id, cut, t, lag(cut) OVER w AS was, lead(cut) OVER w AS later FROM c JOIN f ON c.user_id = f.user_id AND k = cut WINDOW w AS (PARTITION BY c.user_id ORDER BY cut)),
n AS (SELECT x.user_id, cut, was, later, min(f.k) FILTER (f.t >= x.t - 43200 - 1e-9) AS a, max(f.k) FILTER (f.t <= x.t + 43200 + 1e-9) AS b FROM x JOIN f USING (user_id) GROUP BY 1, 2, 3, 4)
SELECT user_id, cut, CAST(least(cut, greatest(a, floor((was + cut) / 2))) AS BIGINT) AS first, CAST(greatest(cut, least(b, floor((cut + later) / 2))) AS BIGINT) AS last FROM n""")
def part_spans(spark, sf_dir):
    """The frames that parts of five days share around their cuts: half a day to either side."""
    w = Window.partitionBy("user_id").orderBy("t")
    f = timed_events(spark, sf_dir).select("user_id", "t", (F.row_number().over(w) - 1).cast("long").alias("k"))
    cuts = f.where(F.col("t") >= PART).groupBy("user_id", F.floor(F.col("t") / PART).alias("p")).agg(F.min("k").alias("k")).drop("p")
    return parts.part_windows(f, cuts, ["user_id"], "k", "t", 2 * OVERLAP)

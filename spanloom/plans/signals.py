"""Queries over recorded signals: rest, stillness, lags, clocks, sampling, shares."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from spanloom.operators import places, sequences as seq, signals
from spanloom.operators.places import quantiles
from spanloom.plans.registry import EVENTS, query, table, timed_events

REST = """, q AS (SELECT user_id, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.5) AS mid, quantile_cont(value, 0.99) AS hi, count(*) AS n FROM ev GROUP BY 1),
k AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k, count(*) OVER (PARTITION BY user_id) AS n FROM ev),
p AS (SELECT k.user_id, value, CAST(k <= greatest(1, floor(k.n * 0.01)) AS INTEGER) + CAST(k > k.n - greatest(1, floor(k.n * 0.01)) AS INTEGER) AS edge, lo, mid, hi, q.n FROM k JOIN q USING (user_id)),
v AS (SELECT user_id, lo, mid, hi, n, count(*) FILTER (value <= lo + 0.1 * (hi - lo)) AS low, count(*) FILTER (value >= hi - 0.1 * (hi - lo)) AS high, sum(edge) AS ends,
  coalesce(sum(edge) FILTER (value <= lo + 0.25 * (hi - lo)), 0) AS el, coalesce(sum(edge) FILTER (value >= hi - 0.25 * (hi - lo)), 0) AS eh FROM p GROUP BY 1, 2, 3, 4, 5),
s AS (SELECT *, CASE WHEN mid - lo <= 0.25 * (hi - lo) THEN -1 WHEN mid - lo >= 0.75 * (hi - lo) THEN 1 ELSE 0 END AS dwell,
  CASE WHEN abs(lo) <= 0.1 * (hi - lo) AND NOT abs(hi) <= 0.1 * (hi - lo) THEN -1 WHEN abs(hi) <= 0.1 * (hi - lo) AND NOT abs(lo) <= 0.1 * (hi - lo) THEN 1 ELSE 0 END AS zero,
  CASE WHEN el > eh AND el * 2 >= ends THEN -1 WHEN eh > el AND eh * 2 >= ends THEN 1 ELSE 0 END AS by_ends FROM v),
r AS (SELECT *, CASE WHEN NOT hi > lo THEN 0 WHEN low >= 0.3 * n OR high >= 0.3 * n THEN
  CASE WHEN by_ends <> 0 AND zero <> 0 AND zero <> by_ends THEN CASE WHEN dwell <> 0 THEN dwell ELSE zero END WHEN by_ends <> 0 THEN by_ends WHEN zero <> 0 THEN zero ELSE dwell END ELSE dwell END AS side FROM s),
l AS (SELECT user_id, lo, mid, hi, side, CASE side WHEN -1 THEN lo WHEN 1 THEN hi ELSE mid END AS level FROM r)"""


@query(EVENTS + REST + " SELECT user_id, round(lo, 6) AS lo, round(mid, 6) AS mid, round(hi, 6) AS hi, CAST(side AS INTEGER) AS side, round(level, 6) AS level FROM l")
def resting_level(spark, sf_dir):
    d = signals.rest(timed_events(spark, sf_dir), ["user_id"], ["event_id"], "value")
    return d.select("user_id", *(F.round(c, 6).alias(c) for c in ("lo", "mid", "hi")), "side", F.round("level", 6).alias("level"))


@query(EVENTS + REST + " SELECT user_id, round(quantile_cont(abs(value - level), 0.99), 6) AS swing FROM ev JOIN l USING (user_id) GROUP BY 1")
def swing_from_rest(spark, sf_dir):
    ev = timed_events(spark, sf_dir)
    levels = signals.rest(ev, ["user_id"], ["event_id"], "value")
    return signals.swing(ev, ["user_id"], "value", levels).select("user_id", F.round("swing", 6).alias("swing"))


def components(spark, sf_dir):
    """Embeddings as recordings (by label) of 64 values a frame, in long form."""
    return table(spark, sf_dir, "embeddings").select("label", "vec_id", F.posexplode("embedding").alias("i", "x")).withColumn("x", F.col("x").cast("double"))


LONG = "WITH l AS (SELECT label, vec_id, CAST(i - 1 AS INTEGER) AS i, CAST(embedding[i] AS DOUBLE) AS x FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings))"


@query(LONG + """, s AS (SELECT *, abs(x - lag(x) OVER (PARTITION BY label, i ORDER BY vec_id)) AS step FROM l),
c AS (SELECT label, i, max(x) - min(x) AS r, quantile_cont(step, 0.5) AS m FROM s GROUP BY 1, 2)
SELECT label, round(greatest(0.1 * quantile_cont(r, 0.99), quantile_cont(m, 0.5)), 6) AS threshold FROM c GROUP BY 1""")
def change_threshold(spark, sf_dir):
    d = signals.change_threshold(components(spark, sf_dir), ["label"], "i", ["vec_id"], "x")
    return d.select("label", F.round("threshold", 6).alias("threshold"))


@query(LONG + """, f AS (SELECT label, i // 16 AS region, x, vec_id, i FROM l), m AS (SELECT label, i, quantile_cont(x, 0.5) AS rest FROM f GROUP BY 1, 2)
SELECT f.label, vec_id, region, round(avg(x - rest), 6) AS signed, round(avg(greatest(x - rest, 0)), 6) AS rising, round(avg(greatest(rest - x, 0)), 6) AS falling FROM f JOIN m ON f.label = m.label AND f.i = m.i GROUP BY 1, 2, 3""")
def regional_response(spark, sf_dir):
    """Mean signed, rising and falling change of each region of 16 values from the values' medians."""
    d = components(spark, sf_dir).withColumn("region", F.floor(F.col("i") / 16).cast("int"))
    m = d.groupBy("label", "i").agg(F.percentile("x", 0.5).alias("rest"))
    change = F.col("x") - F.col("rest")
    out = d.join(m, ["label", "i"]).groupBy("label", "vec_id", "region")
    return out.agg(F.round(F.avg(change), 6).alias("signed"), F.round(F.avg(F.greatest(change, F.lit(0.0))), 6).alias("rising"), F.round(F.avg(F.greatest(-change, F.lit(0.0))), 6).alias("falling"))


@query(LONG + """, g AS (SELECT vec_id, i // 8 AS r, i % 8 AS c, abs(x) AS v FROM l), t AS (SELECT vec_id, v, row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, r, c) AS k FROM g)
SELECT g.vec_id, round(sum(g.v), 6) AS intensity, count(*) FILTER (g.v > 0.2) AS active, round(any_value(t.top) / sum(g.v), 6) AS focus, round(sum(g.v * r) / sum(g.v), 6) AS centre_row, round(sum(g.v * c) / sum(g.v), 6) AS centre_column
FROM g JOIN (SELECT vec_id, sum(v) AS top FROM t WHERE k <= 6 GROUP BY 1) t USING (vec_id) GROUP BY 1""")
def pressure_map(spark, sf_dir):
    """Each vector as a map of 8 x 8 cells: strength, active cells, the strongest tenth's share, centre."""
    v = F.transform("embedding", lambda x: F.abs(x.cast("double")))
    d = table(spark, sf_dir, "embeddings").select("vec_id", v.alias("v"))
    add = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    total = add(F.col("v"))
    weighed = lambda place: F.round(add(F.transform("v", lambda x, i: x * place(i))) / total, 6)
    top = add(F.slice(F.sort_array("v", asc=False), 1, 6))
    return d.select("vec_id", F.round(total, 6).alias("intensity"), F.size(F.filter("v", lambda x: x > 0.2)).cast("long").alias("active"), F.round(top / total, 6).alias("focus"), weighed(lambda i: F.floor(i / 8)).alias("centre_row"), weighed(lambda i: i % 8).alias("centre_column"))


@query(LONG + """ SELECT vec_id, (i // 8) // 2 AS block_row, (i % 8) // 4 AS block_column, round(quantile_cont(x, 0.5), 6) AS median, round(quantile_cont(x, 0.1), 6) AS p10, round(quantile_cont(x, 0.9), 6) AS p90, round(avg(CASE WHEN x > 0 THEN 1.0 ELSE 0.0 END), 6) AS valid FROM l GROUP BY 1, 2, 3""")
def spatial_grid(spark, sf_dir):
    """Percentiles and the share of valid readings in each block of the 8 x 8 map."""
    d = components(spark, sf_dir).withColumns({"block_row": F.floor(F.col("i") / 16).cast("int"), "block_column": F.floor(F.col("i") % 8 / 4).cast("int")})
    p = lambda q, name: F.round(F.percentile("x", q), 6).alias(name)
    return d.groupBy("vec_id", "block_row", "block_column").agg(p(0.5, "median"), p(0.1, "p10"), p(0.9, "p90"), F.round(F.avg((F.col("x") > 0).cast("double")), 6).alias("valid"))


@query(EVENTS + " SELECT event_type, count(*) AS n, round(min(value), 6) AS least, round(max(value), 6) AS most, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS spread, round(avg(CASE WHEN isfinite(value) THEN 1.0 ELSE 0.0 END), 6) AS finite FROM ev GROUP BY 1")
def number_summary(spark, sf_dir):
    x = signals.reading(F.col("value"))
    return timed_events(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("n"), *(F.round(f, 6).alias(c) for f, c in ((F.min(x), "least"), (F.max(x), "most"), (F.avg(x), "mean"), (F.stddev_pop(x), "spread"), (F.avg(x.isNotNull().cast("double")), "finite"))))


@query(EVENTS + """, b AS (SELECT user_id, max(value) AS hi, min(value) AS lo, quantile_cont(value, 0.99) AS top, count(*) AS n FROM ev GROUP BY 1),
d AS (SELECT user_id, value, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY event_id)) AS step FROM ev),
s AS (SELECT b.user_id, b.n, hi = lo AS constant, count(*) FILTER (value >= top) AS pinned, count(*) FILTER (step < 0.01 * (hi - lo)) AS slow FROM d JOIN b USING (user_id) GROUP BY 1, 2, 3)
SELECT user_id, CASE WHEN n = 0 THEN 'no reading' WHEN constant THEN 'constant' WHEN pinned > 0.2 * n THEN 'pinned' WHEN slow > 0.5 * n THEN 'slow' ELSE 'fine' END AS finding, pinned, slow FROM s""")
def signal_findings(spark, sf_dir):
    """What is wrong with each user's signal: no reading, constant, pinned to its top, hardly moving."""
    x = signals.reading(F.col("value"))
    d = timed_events(spark, sf_dir).withColumn("x", x).withColumn("step", F.abs(F.col("x") - F.lag("x").over(Window.partitionBy("user_id").orderBy("event_id"))))
    b = d.groupBy("user_id").agg(F.max("x").alias("hi"), F.min("x").alias("lo"), F.percentile("x", 0.99).alias("top"), F.count("x").alias("n"))
    s = d.join(b, "user_id").groupBy("user_id", "n", (F.col("hi") == F.col("lo")).alias("constant")).agg(F.count_if(F.col("x") >= F.col("top")).alias("pinned"), F.count_if(F.col("step") < 0.01 * (F.col("hi") - F.col("lo"))).alias("slow"))
    finding = F.when(F.col("n") == 0, "no reading").when(F.col("constant"), "constant").when(F.col("pinned") > 0.2 * F.col("n"), "pinned").when(F.col("slow") > 0.5 * F.col("n"), "slow").otherwise("fine")
    return s.select("user_id", finding.alias("finding"), "pinned", "slow")


LAGS = EVENTS + """, m AS (SELECT user_id, event_id, value, avg(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS follows, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM ev),
c AS (SELECT a.user_id, b.k - a.k AS lag, CASE WHEN count(*) >= 3 THEN corr(a.value, b.follows) END AS r FROM m a JOIN m b ON a.user_id = b.user_id AND b.k BETWEEN a.k AND a.k + 4 GROUP BY 1, 2),
n AS (SELECT *, lag(r) OVER w AS ra, lead(r) OVER w AS rb FROM c WHERE r IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY lag)),
t AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY r DESC, lag) AS place FROM n),
pk AS (SELECT user_id, CASE WHEN ra IS NULL OR rb IS NULL THEN lag ELSE lag + CASE WHEN ra - 2 * r + rb <> 0 THEN 0.5 * (ra - rb) / (ra - 2 * r + rb) ELSE 0 END END AS peak FROM t WHERE place = 1)"""


def follower(spark, sf_dir):
    """Values and a follower of them: their mean over the last three."""
    ev = timed_events(spark, sf_dir)
    d = ev.withColumn("follows", F.avg("value").over(Window.partitionBy("user_id").orderBy("event_id").rowsBetween(-2, 0)))
    return signals.peak_lag(seq.lagged_correlation(d, ["user_id"], ["event_id"], "value", "follows", range(5)), ["user_id"])


@query(LAGS + " SELECT user_id, round(peak, 5) AS peak FROM pk")
def follower_lag(spark, sf_dir):
    return follower(spark, sf_dir).select("user_id", F.round("peak", 5).alias("peak"))


@query(LAGS + """, d AS (SELECT user_id, event_id, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY event_id)) AS step FROM ev),
e AS (SELECT *, lag(step) OVER (PARTITION BY user_id ORDER BY event_id) AS b, lead(step) OVER (PARTITION BY user_id ORDER BY event_id) AS a FROM d),
j AS (SELECT user_id, avg(CASE WHEN step / ((a + b) / 2) >= 1.5 THEN 1.0 ELSE 0.0 END) AS skipped, avg(CASE WHEN step / ((a + b) / 2) <= 0.1 THEN 1.0 ELSE 0.0 END) AS repeated FROM e WHERE step IS NOT NULL AND (a + b) / 2 > 1 GROUP BY 1),
nb AS (SELECT user_id, quantile_cont(peak, 0.5) OVER (ORDER BY user_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS neighbours FROM pk)
SELECT pk.user_id, round(peak / 30, 6) AS lag_s, round(skipped, 6) AS skipped, round(repeated, 6) AS repeated, coalesce(skipped + repeated >= 0.02 AND peak / 30 <= 3.4 / 30 AND neighbours / 30 <= 3.4 / 30, false) AS sped_up FROM pk JOIN nb USING (user_id) LEFT JOIN j USING (user_id)""")
def timebase_check(spark, sf_dir):
    """Lag, faulty steps and neighbours' lags together; recordings are ordered in ranges, and
    neighbours looked up in chunks that overlap."""
    lags = places.in_chunks(places.placed(follower(spark, sf_dir), ["user_id"]), 1024, 3)
    lags = seq.rolling_median(lags, ["chunk"], ["user_id"], "peak", 3, "neighbours").where("inner")
    j = seq.jitter(timed_events(spark, sf_dir), ["user_id"], ["event_id"], "value", 1.0)
    d = lags.join(j, "user_id", "left")
    rule = signals.sped_up(F.col("peak") / 30, F.col("skipped"), F.col("repeated"), F.col("neighbours") / 30)
    return d.select("user_id", F.round(F.col("peak") / 30, 6).alias("lag_s"), F.round("skipped", 6).alias("skipped"), F.round("repeated", 6).alias("repeated"), rule.alias("sped_up"))


@query(EVENTS + """, b AS (SELECT user_id, count(*) AS n, min(t) AS a, max(t) AS z, CASE WHEN max(t) > min(t) THEN (count(*) - 1) / (max(t) - min(t)) END AS own FROM ev GROUP BY 1), s AS (SELECT *, CASE user_id % 3 WHEN 0 THEN 30.0 WHEN 1 THEN own * 2 END AS stated FROM b)
SELECT user_id, round(CASE WHEN own IS NULL OR stated IS NULL OR stated <= 0 OR own / 10 <= stated AND stated <= own * 10 THEN stated ELSE round(own, 3) END, 6) AS rate, round(coalesce(n / own, n / stated), 3) AS seconds, round(z - a + 1 / own, 3) AS captured FROM s""")
def supported_rate(spark, sf_dir):
    """The stated rate (absent, near or far off), the recording's length and that of its captures."""
    b = seq.clock_report(timed_events(spark, sf_dir), ["user_id"], "t").join(timed_events(spark, sf_dir).groupBy("user_id").agg(F.min("t").alias("a"), F.max("t").alias("z")), "user_id")
    stated = F.when(F.col("user_id") % 3 == 0, 30.0).when(F.col("user_id") % 3 == 1, F.col("span_rate") * 2)
    own = F.col("span_rate")
    return b.select("user_id", F.round(signals.supported_rate(stated, own), 6).alias("rate"), F.round(F.coalesce(F.col("n") / own, F.col("n") / stated), 3).alias("seconds"), F.round(F.col("z") - F.col("a") + 1 / own, 3).alias("captured"))


@query(EVENTS + """, c AS (SELECT user_id, event_id, CASE WHEN user_id % 4 = 1 THEN -t WHEN user_id % 4 = 2 THEN 5.0 WHEN user_id % 4 = 3 AND event_type = 'view' THEN NULL ELSE t END AS t FROM ev),
k AS (SELECT *, row_number() OVER w - 1 AS k, t < lag(t) OVER w AS back, coalesce(first_value(t) OVER w, 0) AS f FROM c WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
p AS (SELECT user_id, CASE WHEN bool_or(t IS NULL) THEN 'nonfinite' WHEN bool_or(coalesce(back, false)) THEN 'backwards' WHEN min(t) = max(t) AND count(*) > 1 THEN 'tied' END AS problem FROM k GROUP BY 1)
SELECT k.user_id, event_id, problem, round(CASE WHEN problem IS NULL THEN t ELSE f + k / 30.0 END, 5) AS placed FROM k JOIN p USING (user_id)""")
def placed_clock(spark, sf_dir):
    """Clocks with faults made for this query: backwards, all tied, with missing stamps, fine."""
    u = F.col("user_id") % 4
    d = timed_events(spark, sf_dir).withColumn("t", F.when(u == 1, -F.col("t")).when(u == 2, 5.0).when((u == 3) & (F.col("event_type") == "view"), None).otherwise(F.col("t")))
    return signals.placed_clock(d, ["user_id"], ["event_id"], "t", F.lit(30.0)).select("user_id", "event_id", "problem", F.round("placed", 5).alias("placed"))


@query(EVENTS + """ SELECT user_id, event_id, round(coalesce((t + lag(t) OVER w) / 2, greatest(0, t - 1)), 5) AS shown_from, round(coalesce((t + lead(t) OVER w) / 2, t + coalesce(t - lag(t) OVER w, 1 / 30) / 2), 5) AS shown_until FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY t)""")
def shown_from(spark, sf_dir):
    d = signals.shown(timed_events(spark, sf_dir), ["user_id"], "t", lead=1.0)
    return d.select("user_id", "event_id", F.round("shown_from", 5).alias("shown_from"), F.round("shown_until", 5).alias("shown_until"))


@query(EVENTS + """, r AS (SELECT *, sum(CASE WHEN was IS DISTINCT FROM still THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t) AS run FROM (SELECT user_id, event_id, t, value < 100 AS still, lag(value < 100) OVER (PARTITION BY user_id ORDER BY t) AS was FROM ev)),
p AS (SELECT *, floor((t - first_value(t) OVER w) / CASE WHEN still THEN 172800 ELSE 43200 END) AS p FROM r WINDOW w AS (PARTITION BY user_id, run ORDER BY t)),
n AS (SELECT *, p IS DISTINCT FROM lag(p) OVER (PARTITION BY user_id, run ORDER BY t) AS fresh, lead(t) OVER (PARTITION BY user_id ORDER BY t) IS NULL AS final FROM p)
SELECT user_id, event_id, still FROM n WHERE fresh OR final""")
def sampled_frames(spark, sf_dir):
    """Cadence sampling: every half day while values are high, every two days while they are low."""
    d = timed_events(spark, sf_dir).withColumn("still", F.col("value") < 100)
    return signals.cadence(d, ["user_id"], "t", F.col("still"), 43200, 172800).select("user_id", "event_id", "still")


@query("""WITH e AS (SELECT label, vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings),
s AS (SELECT *, sqrt((x - lag(x) OVER w) * (x - lag(x) OVER w) + (y - lag(y) OVER w) * (y - lag(y) OVER w) + (z - lag(z) OVER w) * (z - lag(z) OVER w)) AS step, (row_number() OVER w - 1) % 10 = 0 AS mark FROM e WINDOW w AS (PARTITION BY label ORDER BY vec_id)),
i AS (SELECT *, sum(CASE WHEN mark THEN 1 ELSE 0 END) OVER (PARTITION BY label ORDER BY vec_id) AS i FROM s),
a AS (SELECT label, i, arg_min(x, vec_id) AS x, arg_min(y, vec_id) AS y, arg_min(z, vec_id) AS z, min(vec_id) AS a, coalesce(max(step) FILTER (NOT mark), 0) AS most FROM i GROUP BY 1, 2)
SELECT a.label, a.a, b.vec_id AS b, round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)), 6) AS move, round(greatest(most, b.step), 6) AS largest_step FROM a JOIN i b ON a.label = b.label AND b.i = a.i + 1 AND b.mark""")
def recorded_motion(spark, sf_dir):
    """Net move and largest step of a point between every tenth frame of a recording."""
    d = table(spark, sf_dir, "embeddings").select("label", "vec_id", *(F.col("embedding")[j].cast("double").alias(f"p{j}") for j in range(3)))
    d = d.withColumn("mark", (F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1) % 10 == 0)
    m = signals.interval_motion(d, ["label"], "vec_id", F.col("mark"), ["p0", "p1", "p2"])
    return m.select("label", "a", "b", F.round("move", 6).alias("move"), F.round("largest_step", 6).alias("largest_step"))


BLOCKS = """WITH n AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1),
st AS (SELECT DISTINCT o_custkey, n, unnest(list_append(range(0, greatest(n - 6, 0) + 1, 4), greatest(n - 6, 0))) AS start FROM n)"""


@query(BLOCKS + " SELECT o_custkey, n, CAST(start AS BIGINT) AS start FROM st")
def window_anchors(spark, sf_dir):
    n = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return signals.window_starts(n, F.col("n"), 6, 4)


@query(BLOCKS + """, k AS (SELECT o_custkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS k FROM orders),
w AS (SELECT k.o_custkey, k, k - start AS place, least(n, 6) AS width, o_totalprice + start AS v FROM k JOIN st ON k.o_custkey = st.o_custkey AND k BETWEEN start AND start + 5)
SELECT o_custkey, CAST(k AS BIGINT) AS frame, round(sum(least(place + 1, width - place) * v) / sum(least(place + 1, width - place)), 4) AS blend FROM w GROUP BY 1, 2""")
def blended_windows(spark, sf_dir):
    """Values of overlapping windows (here: prices offset by the window's start) blended by triangles."""
    o = table(spark, sf_dir, "orders").withColumn("frame", (F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")) - 1).cast("long"))
    n = o.groupBy("o_custkey").agg(F.count("*").alias("n"))
    starts = signals.window_starts(n, F.col("n"), 6, 4)
    d = o.join(starts, "o_custkey").where((F.col("frame") >= F.col("start")) & (F.col("frame") < F.col("start") + 6))
    d = d.withColumns({"place": F.col("frame") - F.col("start"), "width": F.least(F.col("n"), F.lit(6)), "v": F.col("o_totalprice") + F.col("start")})
    return signals.blended(d, ["o_custkey"], "frame", "place", "width", "v").withColumn("blend", F.round("blend", 4))


@query("""WITH s AS (SELECT o_custkey, o_orderkey, CAST(round(o_totalprice / 1000) AS BIGINT) AS size FROM orders),
k AS (SELECT *, row_number() OVER w - 1 AS k, coalesce(sum(size) OVER (PARTITION BY o_custkey ORDER BY size, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, count(*) OVER (PARTITION BY o_custkey) AS n, sum(size) OVER (PARTITION BY o_custkey) AS whole FROM s WINDOW w AS (PARTITION BY o_custkey ORDER BY size, o_orderkey)),
l AS (SELECT *, floor((1000 - before) / (n - k)) AS level FROM k), c AS (SELECT *, arg_min(CASE WHEN size > level THEN level END, CASE WHEN size > level THEN k END) OVER (PARTITION BY o_custkey) AS cut FROM l),
o AS (SELECT *, CASE WHEN whole <= 1000 THEN size ELSE least(size, cut) END AS own FROM c), p AS (SELECT *, 1000 - sum(own) OVER (PARTITION BY o_custkey) AS spare, row_number() OVER (PARTITION BY o_custkey, own < size ORDER BY o_orderkey) AS place FROM o)
SELECT o_custkey, o_orderkey, size, CAST(own + CASE WHEN own < size AND place <= spare THEN 1 ELSE 0 END AS BIGINT) AS share FROM p""")
def fair_shares(spark, sf_dir):
    """How much of a budget of 1,000 each order of a customer keeps."""
    s = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.round(F.col("o_totalprice") / 1000).cast("long").alias("size"))
    return signals.fair_shares(s, ["o_custkey"], ["o_orderkey"], "size", 1000)


@query()
def still_spans(spark, sf_dir):
    """Spans of at least 3 events of a user whose values stay within 60 of each other."""
    return signals.calm_spans(timed_events(spark, sf_dir), ["user_id"], ["t", "event_id"], ["value"], [60.0], 3)


@query()
def quiet_spans(spark, sf_dir):
    """Spans of frames of a recording in which the first three components stay within 1."""
    d = table(spark, sf_dir, "embeddings").select("label", "vec_id", *(F.col("embedding")[j].alias(f"p{j}") for j in range(3)))
    return signals.calm_spans(d, ["label"], ["vec_id"], ["p0", "p1", "p2"], [1.0, 1.0, 1.0], 3, complete=True)


@query(EVENTS + REST + """, sw AS (SELECT user_id, any_value(level) AS level, quantile_cont(abs(value - level), 0.99) AS swing FROM ev JOIN l USING (user_id) GROUP BY 1),
d AS (SELECT user_id, swing, value - level AS d, abs(value - level) > 0.1 * swing AS away FROM ev JOIN sw USING (user_id)),
a AS (SELECT user_id, swing, count(*) AS n, count(*) FILTER (away) AS act, count(*) FILTER (away AND d > 0) AS up, max(d) AS hi, min(d) AS lo, quantile_cont(greatest(d, 0), 0.99) AS over_, quantile_cont(greatest(-d, 0), 0.99) AS under_,
  count(*) FILTER (abs(d) <= 0.1 * swing) AS near, count(*) FILTER (abs(d) <= 0.02 * swing) AS held, max(CASE WHEN away THEN abs(d) ELSE 0 END) AS most FROM d GROUP BY 1, 2),
o AS (SELECT user_id, count(*) FILTER (away AND abs(d) >= 0.1 * most) AS act_on FROM d JOIN (SELECT user_id, most FROM a) USING (user_id) GROUP BY 1),
b AS (SELECT user_id, CASE WHEN swing > 0 AND act > 0 AND up * 5 >= act * 4 AND under_ <= 0.1 * hi THEN 'up' WHEN swing > 0 AND act > 0 AND NOT up * 5 >= act * 4 AND up * 5 <= act AND over_ <= -0.1 * lo THEN 'down' END AS direction,
  coalesce(swing > 0 AND near > 0 AND near >= 0.02 * n AND held >= 0.3 * near, false) AS has_rest, n >= 5 AND most > 0 AND n - act_on >= 0.02 * n AND act_on >= 0.02 * n AS often FROM a JOIN o USING (user_id))
SELECT user_id, direction, has_rest, has_rest AND direction IS NOT NULL AND coalesce(often, false) AS touch_like FROM b""")
def signal_behaviour(spark, sf_dir):
    ev = timed_events(spark, sf_dir)
    levels = signals.rest(ev, ["user_id"], ["event_id"], "value")
    return signals.behaviour(ev, ["user_id"], "value", levels, signals.swing(ev, ["user_id"], "value", levels))


@query(LONG + """, s AS (SELECT label, i, x, abs(x - lag(x) OVER (PARTITION BY label, i ORDER BY vec_id)) AS step FROM l),
m AS (SELECT label, i, max(x) - min(x) AS r, quantile_cont(step, 0.5) FILTER (step > 0) AS m FROM s GROUP BY 1, 2), z AS (SELECT label, vec_id, sum(greatest(x - 0.1, 0)) AS response, 0 AS unused FROM l GROUP BY 1, 2),
qq AS (SELECT label, avg(response) AS response FROM z GROUP BY 1), ev AS (SELECT label, x AS value, vec_id * 64 + i AS event_id, vec_id FROM l)""" + REST.replace("user_id", "label").replace("l AS (SELECT label, lo", "lv AS (SELECT label, lo").replace(", s AS (", ", s2 AS (").replace("s AS (SELECT *, CASE WHEN mid", "s2 AS (SELECT *, CASE WHEN mid").replace("AS side FROM s)", "AS side FROM s2)") + """,
sw AS (SELECT label, any_value(level) AS level, quantile_cont(abs(value - level), 0.99) AS swing FROM ev JOIN lv USING (label) GROUP BY 1),
hr AS (SELECT label, any_value(swing) > 0 AND count(*) FILTER (abs(value - level) <= 0.1 * swing) > 0 AND count(*) FILTER (abs(value - level) <= 0.1 * swing) >= 0.02 * count(*) AND count(*) FILTER (abs(value - level) <= 0.02 * swing) >= 0.3 * count(*) FILTER (abs(value - level) <= 0.1 * swing) AS has_rest FROM ev JOIN sw USING (label) GROUP BY 1),
sh AS (SELECT label, vec_id, avg(CASE WHEN abs(value - level) > 0.1 * swing THEN 1.0 ELSE 0.0 END) AS share FROM ev JOIN sw USING (label) GROUP BY 1, 2), md AS (SELECT label, quantile_cont(share, 0.5) AS middle FROM sh WHERE share > 0 GROUP BY 1)
SELECT label, round(avg(coalesce(r / m, 0)), 5) AS movements, any_value(has_rest) AND coalesce(any_value(middle) < 0.5, false) AS localized, round(any_value(response), 5) AS response FROM m JOIN qq USING (label) JOIN hr USING (label) LEFT JOIN md USING (label) GROUP BY 1""")
def recording_activity(spark, sf_dir):
    """How much the values of a recording move for the size of a move, whether it rests and few are
    active at once, and the mean response above a declared zero."""
    d = components(spark, sf_dir)
    step = F.abs(F.col("x") - F.lag("x").over(Window.partitionBy("label", "i").orderBy("vec_id")))
    per = d.withColumn("step", step).groupBy("label", "i").agg((F.max("x") - F.min("x")).alias("r"))
    per = per.join(quantiles(d.withColumn("step", step), ["label", "i"], F.when(F.col("step") > 0, F.col("step")), {"m": 0.5}), ["label", "i"])
    moved = per.groupBy("label").agg(F.round(F.avg(F.coalesce(F.try_divide("r", "m"), F.lit(0.0))), 5).alias("movements"))
    v = table(spark, sf_dir, "embeddings").select("label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    response = F.aggregate("v", F.lit(0.0), lambda s, x: s + F.greatest(x - 0.1, F.lit(0.0)))
    active = v.select("label", response.alias("response")).groupBy("label").agg(F.round(F.avg("response"), 5).alias("response"))
    levels = signals.rest(d, ["label"], ["vec_id", "i"], "x")
    swings = signals.swing(d, ["label"], "x", levels)
    local = signals.localized(d, ["label"], "vec_id", "x", levels, swings, signals.behaviour(d, ["label"], "x", levels, swings))
    return moved.join(active, "label").join(local, "label")


@query("""SELECT l_orderkey, l_linenumber, isfinite(l_extendedprice) AND l_extendedprice > 0 AND l_extendedprice <> 65535 AS valid, round(1 - (ln(greatest(100, least(50000, l_extendedprice))) - ln(100)) / (ln(50000) - ln(100)), 9) AS place,
  CASE WHEN l_quantity < 10 THEN 'dark ' ELSE '' END || CASE WHEN l_partkey % 360 < 30 THEN 'red' WHEN l_partkey % 360 < 90 THEN 'yellow' WHEN l_partkey % 360 < 160 THEN 'green' WHEN l_partkey % 360 < 270 THEN 'blue' ELSE 'purple' END AS colour FROM lineitem""")
def reading_scale(spark, sf_dir):
    """Whether a reading counts, its place on a log scale, and the word of its hue."""
    x, hue = F.col("l_extendedprice"), F.col("l_partkey") % 360
    word = F.when(hue < 30, "red").when(hue < 90, "yellow").when(hue < 160, "green").when(hue < 270, "blue").otherwise("purple")
    dark = F.when(F.col("l_quantity") < 10, "dark ").otherwise("")
    ok = signals.reading(x).isNotNull() & (x > 0) & (x != 65535)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", ok.alias("valid"), F.round(signals.on_log_scale(x, 100.0, 50000.0), 9).alias("place"), F.concat(dark, word).alias("colour"))

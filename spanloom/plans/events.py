"""Queries over the event stream: intervals, sequences, as-of placement."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from spanloom.operators import asof, intervals, sampling, sequences as seq
from spanloom.plans.registry import EVENTS, query, table, timed_events

GAP = 43200.0


def as_spans(spark, sf_dir):
    """Each event covers [t, t + value seconds)."""
    return timed_events(spark, sf_dir).select("user_id", "event_id", "event_type", F.col("t").alias("s"), (F.col("t") + F.col("value") * 100).alias("e"))


SPANS = EVENTS + ", sp AS (SELECT user_id, event_id, event_type, t AS s, t + value * 100 AS e FROM ev)"
SESSIONS = EVENTS + f""", fl AS (
  SELECT *, CASE WHEN t - lag(t) OVER w > {GAP} THEN 1 ELSE 0 END AS f FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)),
se AS (SELECT *, CAST(sum(f) OVER (PARTITION BY user_id ORDER BY t, event_id) AS BIGINT) AS session FROM fl)"""


@query(SESSIONS + """ SELECT user_id, session, count(*) AS n, round(min(t), 3) AS first_t, round(max(t), 3) AS last_t,
  round(max(t) - min(t), 3) AS seconds, round(quantile_cont(value, 0.5), 6) AS median_value, count(DISTINCT event_type) AS kinds FROM se GROUP BY 1, 2""")
def session_summary(spark, sf_dir):
    d = seq.sessions(timed_events(spark, sf_dir), ["user_id"], "t", GAP, "event_id")
    return d.groupBy("user_id", "session").agg(
        F.count("*").alias("n"), F.round(F.min("t"), 3).alias("first_t"), F.round(F.max("t"), 3).alias("last_t"), F.round(F.max("t") - F.min("t"), 3).alias("seconds"),
        F.round(F.percentile("value", 0.5), 6).alias("median_value"), F.countDistinct("event_type").alias("kinds"),
    )


@query(SESSIONS + """ SELECT user_id, session, event_id, round(quantile_cont(value, 0.5) OVER (PARTITION BY user_id, session ORDER BY t, event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 6) AS rolling FROM se""")
def session_rolling_median(spark, sf_dir):
    d = seq.sessions(timed_events(spark, sf_dir), ["user_id"], "t", GAP, "event_id")
    d = seq.rolling_median(d, ["user_id", "session"], ["t", "event_id"], "value")
    return d.select("user_id", "session", "event_id", F.round("rolling", 6).alias("rolling"))


@query(SESSIONS + """, n AS (SELECT user_id, session, count(*) AS n FROM se GROUP BY 1, 2)
SELECT n.user_id, count(*) AS sessions, count(*) FILTER (n >= 3) AS unbroken FROM n GROUP BY 1""")
def session_neighbours(spark, sf_dir):
    d = seq.sessions(timed_events(spark, sf_dir), ["user_id"], "t", GAP, "event_id").groupBy("user_id", "session").agg(F.count("*").alias("n"))
    return d.groupBy("user_id").agg(F.count("*").alias("sessions"), F.count_if(F.col("n") >= 3).alias("unbroken"))


@query(EVENTS + """, d AS (SELECT user_id, t, t - lag(t) OVER (PARTITION BY user_id ORDER BY t) AS dt FROM ev),
b AS (SELECT user_id, count(*) AS n, quantile_cont(dt, 0.5) AS m, max(dt) AS longest, min(t) AS a, max(t) AS z FROM d GROUP BY 1),
g AS (SELECT user_id, count(*) FILTER (dt > 1.5 * m) AS gaps, sum(dt) FILTER (dt <= 1.5 * m) AS live, count(*) FILTER (dt <= 1.5 * m) AS k FROM d JOIN b USING (user_id) GROUP BY 1),
r AS (SELECT b.*, gaps, CASE WHEN z > a THEN (n - 1) / (z - a) END AS span_rate, CASE WHEN m > 0 THEN 1.0 / m END AS median_rate, CASE WHEN live > 0 THEN k / live END AS paused FROM b JOIN g USING (user_id))
SELECT user_id, n, round(m, 3) AS median_step, round(longest, 3) AS longest, gaps, round(span_rate, 9) AS span_rate, round(median_rate, 9) AS median_rate,
  round(CASE WHEN abs(median_rate - paused) > 0.02 * paused THEN paused ELSE median_rate END, 9) AS rate FROM r""")
def gap_report(spark, sf_dir):
    d = seq.clock_report(timed_events(spark, sf_dir), ["user_id"], "t")
    return d.select("user_id", "n", F.round("median_step", 3).alias("median_step"), F.round("longest", 3).alias("longest"), "gaps", *(F.round(c, 9).alias(c) for c in ("span_rate", "median_rate", "rate")))


@query("""WITH d AS (SELECT user_id, event_id, value, abs(value - lag(value) OVER w) AS step FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
n AS (SELECT *, lag(step) OVER w AS b, lead(step) OVER w AS a FROM d WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
p AS (SELECT user_id, quantile_cont(step, 0.95) AS p95 FROM d GROUP BY 1),
t AS (SELECT n.*, row_number() OVER (PARTITION BY user_id ORDER BY step DESC, event_id) AS k FROM n WHERE step IS NOT NULL),
q AS (SELECT t.*, row_number() OVER (PARTITION BY user_id ORDER BY step DESC, event_id) AS rank FROM t JOIN p USING (user_id)
  WHERE k <= 6 AND step >= greatest(5.0, 0.9 * p95) AND step >= 1.5 * coalesce(b, 0) AND step >= 1.5 * coalesce(a, 0))
SELECT user_id, event_id, round(step, 6) AS step, CAST(rank AS INTEGER) AS rank FROM q WHERE rank <= 3""")
def value_jumps(spark, sf_dir):
    d = seq.jumps(table(spark, sf_dir, "events"), ["user_id"], ["event_id"], "value", floor=5.0, factor=0.9, isolation=1.5)
    return d.select("user_id", "event_id", F.round("step", 6).alias("step"), "rank")


@query("""WITH d AS (SELECT user_id, event_id, abs(value - lag(value) OVER w) AS step FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
n AS (SELECT *, lag(step) OVER w AS b, lead(step) OVER w AS a FROM d WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
r AS (SELECT *, (a + b) / 2 AS m FROM n)
SELECT user_id, count(*) AS moving, round(avg(CASE WHEN step / m >= 1.5 THEN 1.0 ELSE 0.0 END), 6) AS skipped, round(avg(CASE WHEN step / m <= 0.1 THEN 1.0 ELSE 0.0 END), 6) AS repeated
FROM r WHERE m > 1.0 AND step IS NOT NULL GROUP BY 1""")
def sample_jitter(spark, sf_dir):
    d = seq.jitter(table(spark, sf_dir, "events"), ["user_id"], ["event_id"], "value", still=1.0)
    return d.select("user_id", "moving", F.round("skipped", 6).alias("skipped"), F.round("repeated", 6).alias("repeated"))


@query("""WITH r AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS g FROM events)
SELECT user_id, event_type, min(event_id) AS s, max(event_id) AS e, count(*) AS n FROM r GROUP BY user_id, event_type, g""")
def type_runs(spark, sf_dir):
    return seq.spans(table(spark, sf_dir, "events"), ["user_id"], "event_id", "event_type").drop("run")


MERGED = """, o AS (SELECT *, max(e) OVER (PARTITION BY user_id{k} ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {src} WHERE e > s),
g AS (SELECT *, sum(CASE WHEN s <= reach + {gap} THEN 0 ELSE 1 END) OVER (PARTITION BY user_id{k} ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM o),
m AS (SELECT user_id{k}, min(s) AS s, max(e) AS e, count(*) AS n FROM g GROUP BY user_id{k}, sid)"""


@query(SPANS + MERGED.format(k="", src="sp", gap=0.0) + " SELECT user_id, round(s, 3) AS s, round(e, 3) AS e, n FROM m")
def activity_spans(spark, sf_dir):
    return intervals.merge(as_spans(spark, sf_dir), ["user_id"]).select("user_id", F.round("s", 3).alias("s"), F.round("e", 3).alias("e"), "n")


@query(SPANS + MERGED.format(k="", src="sp", gap=3600.0) + " SELECT user_id, round(s, 3) AS s, round(e, 3) AS e, n FROM m")
def activity_spans_bridged(spark, sf_dir):
    """Gaps of up to an hour are bridged."""
    return intervals.merge(as_spans(spark, sf_dir), ["user_id"], gap=3600.0).select("user_id", F.round("s", 3).alias("s"), F.round("e", 3).alias("e"), "n")


@query(SPANS + MERGED.format(k=", event_type", src="sp", gap=0.0) + " SELECT user_id, event_type, round(sum(e - s), 3) AS covered FROM m GROUP BY 1, 2")
def activity_union(spark, sf_dir):
    d = intervals.union_length(as_spans(spark, sf_dir), ["user_id", "event_type"])
    return d.withColumn("covered", F.round("covered", 3))


@query(SPANS + ", cl AS (SELECT user_id, greatest(s, 86400.0) AS s, least(e, 864000.0) AS e FROM sp)" + MERGED.format(k="", src="cl", gap=0.0) + " SELECT user_id, round(sum(e - s) / 777600.0, 9) AS share FROM m GROUP BY 1")
def coverage_share(spark, sf_dir):
    """The share of days 1 to 10 that a user's spans cover."""
    d = intervals.clip(as_spans(spark, sf_dir), F.lit(86400.0), F.lit(864000.0))
    return intervals.union_length(d, ["user_id"]).select("user_id", F.round(F.col("covered") / 777600.0, 9).alias("share"))


@query(SPANS + """, b AS (SELECT user_id, s AS t, 1 AS d FROM sp WHERE e > s UNION ALL SELECT user_id, e, -1 FROM sp WHERE e > s),
c AS (SELECT user_id, t, sum(d) AS d FROM b GROUP BY 1, 2),
w AS (SELECT user_id, t AS s, lead(t) OVER w AS e, CAST(sum(d) OVER w AS BIGINT) AS n_open FROM c WINDOW w AS (PARTITION BY user_id ORDER BY t))
SELECT user_id, round(s, 3) AS s, round(e, 3) AS e, n_open FROM w WHERE n_open > 0 AND e IS NOT NULL""")
def sweep_segments(spark, sf_dir):
    return intervals.segments(as_spans(spark, sf_dir), ["user_id"]).select("user_id", F.round("s", 3).alias("s"), F.round("e", 3).alias("e"), "n_open")


@query(SPANS + """, b AS (SELECT user_id, s AS t, 1 AS da, 0 AS db FROM sp WHERE event_type = 'view' AND e > s UNION ALL SELECT user_id, e, -1, 0 FROM sp WHERE event_type = 'view' AND e > s
  UNION ALL SELECT user_id, s, 0, 1 FROM sp WHERE event_type <> 'view' AND e > s UNION ALL SELECT user_id, e, 0, -1 FROM sp WHERE event_type <> 'view' AND e > s),
c AS (SELECT user_id, t, sum(da) AS da, sum(db) AS db FROM b GROUP BY 1, 2),
w AS (SELECT user_id, t, lead(t) OVER w AS u, sum(da) OVER w AS na, sum(db) OVER w AS nb FROM c WINDOW w AS (PARTITION BY user_id ORDER BY t))
SELECT user_id, round(sum(u - t), 3) AS alone FROM w WHERE na > 0 AND nb = 0 AND u IS NOT NULL GROUP BY 1""")
def activity_difference(spark, sf_dir):
    """Seconds covered by views and by no other event."""
    d = as_spans(spark, sf_dir)
    left = intervals.difference(d.where("event_type = 'view'"), d.where("event_type <> 'view'"), ["user_id"])
    return left.groupBy("user_id").agg(F.round(F.sum(F.col("e") - F.col("s")), 3).alias("alone"))


@query(SPANS + """ SELECT a.user_id, a.event_id, b.event_id AS event_id_r, round(least(a.e, b.e) - greatest(a.s, b.s), 3) AS shared
FROM sp a JOIN sp b ON a.user_id = b.user_id AND least(a.e, b.e) > greatest(a.s, b.s) WHERE a.event_type = 'purchase' AND b.event_type = 'view'""")
def overlap_pairs(spark, sf_dir):
    d = as_spans(spark, sf_dir)
    pairs = intervals.overlaps(d.where("event_type = 'purchase'"), d.where("event_type = 'view'"), ["user_id"], width=86400.0)
    return pairs.select("user_id", "event_id", "event_id_r", F.round("shared", 3).alias("shared"))


@query(SPANS + """, p AS (SELECT a.user_id, a.event_id, b.event_id AS cover_id, least(a.e, b.e) - greatest(a.s, b.s) AS c, a.e - a.s AS len
  FROM sp a JOIN sp b ON a.user_id = b.user_id AND least(a.e, b.e) > greatest(a.s, b.s) WHERE a.event_type = 'purchase' AND b.event_type = 'view'),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_id ORDER BY c DESC, cover_id) AS k FROM p)
SELECT user_id, event_id, cover_id, round(c, 3) AS covered FROM r WHERE k = 1 AND c >= 0.5 * len""")
def best_cover(spark, sf_dir):
    d = as_spans(spark, sf_dir)
    views = d.where("event_type = 'view'").withColumnRenamed("event_id", "cover_id")
    out = intervals.best_cover(d.where("event_type = 'purchase'"), views, ["user_id"], "event_id", "cover_id", width=86400.0)
    return out.withColumn("covered", F.round("covered", 3))


@query(EVENTS + """, a AS (SELECT user_id, event_id, t FROM ev WHERE event_type = 'view'), b AS (SELECT user_id, event_id, t FROM ev WHERE event_type = 'purchase'),
r AS (SELECT a.user_id, a.event_id, b.event_id AS purchase_id, a.t - b.t AS d, row_number() OVER (PARTITION BY a.event_id ORDER BY abs(a.t - b.t), b.t) AS k FROM a JOIN b USING (user_id)),
n AS (SELECT * FROM r WHERE k = 1 AND abs(d) <= 86400.0)
SELECT a.user_id, a.event_id, n.purchase_id, round(abs(n.d), 3) AS apart FROM a LEFT JOIN n ON a.event_id = n.event_id""")
def nearest_purchase(spark, sf_dir):
    d = timed_events(spark, sf_dir).select("user_id", "event_id", "event_type", "t")
    views, buys = d.where("event_type = 'view'").drop("event_type"), d.where("event_type = 'purchase'").drop("event_type")
    m = asof.nearest(views, buys, ["user_id"], "t", "event_id", ["event_id"], tolerance=86400.0)
    return m.select("user_id", "event_id", F.col("m.event_id").alias("purchase_id"), F.round(F.abs(F.col("m.t") - F.col("t")), 3).alias("apart"))


@query(EVENTS + """ SELECT a.user_id, a.event_id, b.event_id AS purchase_id, round(a.t - b.t, 3) AS since
FROM (SELECT * FROM ev WHERE event_type = 'view') a ASOF LEFT JOIN (SELECT * FROM ev WHERE event_type = 'purchase') b ON a.user_id = b.user_id AND a.t >= b.t""")
def last_purchase_before(spark, sf_dir):
    d = timed_events(spark, sf_dir).select("user_id", "event_id", "event_type", "t")
    m = asof.backward(d.where("event_type = 'view'").drop("event_type"), d.where("event_type = 'purchase'").drop("event_type"), ["user_id"], "t", "event_id", ["event_id"])
    return m.select("user_id", "event_id", F.col("m.event_id").alias("purchase_id"), F.round(F.col("t") - F.col("m.t"), 3).alias("since"))


@query(EVENTS + """, a AS (SELECT user_id, event_id, t FROM ev WHERE event_type = 'view'), b AS (SELECT user_id, t, value FROM ev WHERE event_type = 'purchase'),
p AS (SELECT a.user_id, a.event_id, a.t, b.t AS t0, b.value AS v0 FROM a ASOF LEFT JOIN b ON a.user_id = b.user_id AND a.t >= b.t),
n AS (SELECT a.event_id, b.t AS t1, b.value AS v1 FROM a ASOF LEFT JOIN b ON a.user_id = b.user_id AND a.t <= b.t)
SELECT user_id, p.event_id, round(CASE WHEN t1 = t0 THEN v0 WHEN t1 - t0 <= 172800.0 THEN v0 + (v1 - v0) * (t - t0) / (t1 - t0) END, 6) AS placed FROM p JOIN n USING (event_id)""")
def linear_place(spark, sf_dir):
    d = timed_events(spark, sf_dir).select("user_id", "event_id", "event_type", "t", "value")
    m = asof.linear(d.where("event_type = 'view'").drop("event_type", "value"), d.where("event_type = 'purchase'").drop("event_type"), ["user_id"], "t", "event_id", "value", most=172800.0)
    return m.select("user_id", "event_id", F.round("placed", 6).alias("placed"))


@query("""WITH o AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k, ntile(8) OVER (PARTITION BY user_id ORDER BY event_id) AS b, count(*) OVER (PARTITION BY user_id) AS n FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, b ORDER BY value, event_id) AS lo, row_number() OVER (PARTITION BY user_id, b ORDER BY value DESC, event_id) AS hi FROM o)
SELECT user_id, event_id, value FROM r WHERE lo = 1 OR hi = 1 OR k = 1 OR k = n""")
def bucket_extrema(spark, sf_dir):
    d = table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    return seq.bucket_extrema(d, ["user_id"], "event_id", "value", 8)


@query("""WITH l AS (SELECT user_id, value AS x, lead(value, 0) OVER w AS y0, lead(value, 1) OVER w AS y1, lead(value, 2) OVER w AS y2 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
u AS (SELECT user_id, 1 AS lag, x, y1 AS y FROM l UNION ALL SELECT user_id, 2, x, y2 FROM l)
SELECT user_id, lag, count(*) AS n, round(corr(x, y), 6) AS r FROM u WHERE y IS NOT NULL GROUP BY 1, 2""")
def lagged_corr(spark, sf_dir):
    d = seq.lagged_correlation(table(spark, sf_dir, "events"), ["user_id"], ["event_id"], "value", "value", range(1, 3))
    return d.select("user_id", "lag", "n", F.round("r", 6).alias("r"))


@query("""SELECT user_id, event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 4) AS moving FROM events""")
def moving_sum(spark, sf_dir):
    d = seq.moving_sum(table(spark, sf_dir, "events"), ["user_id"], ["event_id"], "value", 2)
    return d.select("user_id", "event_id", F.round("moving", 4).alias("moving"))


@query("""WITH m AS (SELECT event_type, quantile_cont(value, 0.5) AS median FROM events GROUP BY 1), a AS (SELECT e.*, median, abs(value - median) AS a FROM events e JOIN m USING (event_type)),
d AS (SELECT event_type, quantile_cont(a, 0.5) AS mad FROM a GROUP BY 1)
SELECT event_id, event_type, value, round(median, 6) AS median, round(mad, 6) AS mad FROM a JOIN d USING (event_type) WHERE mad > 0 AND a > 4 * mad""")
def robust_outliers(spark, sf_dir):
    d = seq.robust_outliers(table(spark, sf_dir, "events").select("event_id", "event_type", "value"), ["event_type"], "value", 4.0)
    return d.select("event_id", "event_type", "value", F.round("median", 6).alias("median"), F.round("mad", 6).alias("mad"))


@query("""WITH f AS (SELECT user_id, event_id, epoch_us(ts) // 3600000000 AS h FROM events), c AS (SELECT *, count(*) OVER (PARTITION BY user_id, h) AS n, row_number() OVER (PARTITION BY user_id, h ORDER BY event_id) AS k FROM f),
s AS (SELECT user_id, h, lead(h) OVER (PARTITION BY user_id ORDER BY h) AS nx FROM (SELECT DISTINCT user_id, h FROM f))
SELECT c.user_id, event_id, round(c.h + coalesce(nx - c.h, 0) * (k - 1) / n, 6) AS placed FROM c JOIN s USING (user_id, h)""")
def spread_ties(spark, sf_dir):
    """Events known to the hour only, spread up to the next hour with an event."""
    from spanloom.plans.registry import micros

    d = table(spark, sf_dir, "events").select("user_id", "event_id", F.floor(micros("ts") / 3600000000).cast("double").alias("h"))
    return seq.spread_ties(d, ["user_id"], "h", "event_id").select("user_id", "event_id", F.round("placed", 6).alias("placed"))


@query("""SELECT user_id, sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS k_sum, max(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS k_max, count(json_extract_string(props, '$.k')) AS n FROM events GROUP BY 1""")
def json_props_agg(spark, sf_dir):
    d = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    return d.groupBy("user_id").agg(F.sum("k").alias("k_sum"), F.max("k").alias("k_max"), F.count("k").alias("n"))


@query("""WITH c AS (SELECT user_id, event_id, value, sum(value) OVER (PARTITION BY user_id ORDER BY event_id) AS spent FROM events)
SELECT user_id, event_id, value, round(spent, 4) AS spent FROM c WHERE spent - value < 1000""")
def spend_until_cap(spark, sf_dir):
    d = table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    return sampling.until_cap(d, ["user_id"], [F.col("event_id")], "value", 1000.0).withColumn("spent", F.round("spent", 4))


@query("""WITH r AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY CASE event_type WHEN 'purchase' THEN 0 WHEN 'view' THEN 1 ELSE 2 END, event_id DESC) AS k FROM events)
SELECT user_id, event_id, event_type FROM r WHERE k = 1""")
def precedence_latest(spark, sf_dir):
    d = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    rank = F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "view", 1).otherwise(2)
    return sampling.latest(d, ["user_id"], [rank, F.desc("event_id")])


@query("""WITH b AS (SELECT event_type, epoch_us(ts) // 86400000000 AS day, value FROM events)
SELECT event_type, day, count(*) AS n, round(sum(value), 4) AS total, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS spread, min(value) AS least, max(value) AS most FROM b GROUP BY 1, 2""")
def daily_type_totals(spark, sf_dir):
    from spanloom.plans.registry import micros

    d = table(spark, sf_dir, "events").withColumn("day", F.floor(micros("ts") / 86400000000))
    return d.groupBy("event_type", "day").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"), F.round(F.avg("value"), 6).alias("mean"), F.round(F.stddev_pop("value"), 6).alias("spread"), F.min("value").alias("least"), F.max("value").alias("most"))


@query("""WITH r AS (SELECT user_id, event_id, max(value) OVER (PARTITION BY user_id ORDER BY event_id) AS level, value FROM events), p AS (SELECT *, lag(level) OVER (PARTITION BY user_id ORDER BY event_id) AS was FROM r)
SELECT user_id, event_id, level FROM p WHERE was IS NULL OR level > was""")
def progress_levels(spark, sf_dir):
    """Rows that raise the running maximum."""
    w = Window.partitionBy("user_id").orderBy("event_id")
    d = table(spark, sf_dir, "events").withColumn("level", F.max("value").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.withColumn("was", F.lag("level").over(w))
    return d.where("was is null or level > was").select("user_id", "event_id", "level")


@query("""SELECT user_id, event_type, count(*) AS n, round(regr_slope(value, event_id), 9) AS slope, round(regr_intercept(value, event_id), 4) AS intercept FROM events GROUP BY 1, 2 HAVING count(*) >= 3""")
def line_through(spark, sf_dir):
    d = table(spark, sf_dir, "events").groupBy("user_id", "event_type")
    return d.agg(F.count("*").alias("n"), F.round(F.regr_slope("value", "event_id"), 9).alias("slope"), F.round(F.regr_intercept("value", "event_id"), 4).alias("intercept")).where("n >= 3")

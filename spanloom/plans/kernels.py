"""Queries of order-dependent work: cuts, smoothing, shapes, readouts, codecs, joins across
cuts; of nested documents and of what texts assert."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from spanloom.functions import assertions
from spanloom.functions.numbers import DIGITS
from spanloom.operators import clocks, documents, exports, readout, sampling, seams, summaries, tracks
from spanloom.plans.registry import EVENTS, query, table, timed_events
from spanloom.session import new_folder
from spanloom.sources import index

DAY = 86400.0


@query()
def asserted_topics(spark, sf_dir):
    """For each source and topic the documents that assert it and those that only name it, and
    the characters that they deny."""
    d = assertions.readings(table(spark, sf_dir, "documents").select("source", "text"), "text", {"insult": r"\b(pathetic|worthless|loser|scum|disgusting)\b", "place": r"\b(here|there|where)\b", "doubt": r"\b(perhaps|maybe|que)\b"})
    f = d.select("source", F.explode("reading.families").alias("f"), F.aggregate("reading.denied", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"]).alias("denied"))
    return f.groupBy("source", F.col("f.family").alias("topic")).agg(F.count_if("f.asserted").alias("asserted"), F.count_if(~F.col("f.asserted")).alias("named"), F.sum("denied").alias("denied"))


@query()
def quiet_cuts(spark, sf_dir):
    """Each user's events parted into stretches of at most eight days, at events of low value."""
    cuts = tracks.choose_cuts(timed_events(spark, sf_dir), ["user_id"], "t", "value", 8 * DAY, smooth_s=DAY)
    return cuts.select("user_id", "frame", F.round("t", 3).alias("t"), F.round("motion", 6).alias("motion"), "still", F.round("target", 1).alias("target"), "problem")


def frames(spark, sf_dir):
    """Embeddings as frames of recordings (by label), numbered without gaps."""
    k = (F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1).cast("long")
    return table(spark, sf_dir, "embeddings").select("label", "vec_id", k.alias("frame"), "embedding")


@query()
def smoothed_points(spark, sf_dir):
    """32 points of every frame smoothed over the runs between every 50th frame, which is absent."""
    d = frames(spark, sf_dir)
    return tracks.smooth_both_ways(d, ["label"], "frame", "embedding", F.col("frame") % 50 != 49, 30.0).select("label", "frame", F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x), 6).alias("sum"))


@query()
def shape_changes(spark, sf_dir):
    """21 points of every frame against the first frame and the one before, and a chain's curl."""
    d = frames(spark, sf_dir).withColumn("points", F.slice("embedding", 1, 63))
    s = tracks.point_shapes(d, ["label"], "frame", "points")
    c = d.select("label", "frame", F.round(tracks.curl(F.col("points"), [0, 4, 8, 12]), 6).alias("curl"))
    return s.join(c, ["label", "frame"]).withColumns({"first": F.round("first", 6), "adjacent": F.round("adjacent", 6)})


@query()
def signal_tiers(spark, sf_dir):
    """What of each recording's values a readout of every tenth frame shows: some follow others."""
    v = F.col("embedding")
    x = F.concat(F.slice(v, 1, 16), F.transform(F.slice(v, 1, 4), lambda x: 3 - 2 * x))
    return readout.signal_readout(frames(spark, sf_dir).withColumn("v", x), ["label"], "frame", "v", list(range(20)), 10, 30.0, room=3000)


@query("SELECT label, vec_id, true AS near FROM embeddings")
def coded_points(spark, sf_dir):
    """Whether the frames of each recording come back from their codes within the tolerance."""
    d = frames(spark, sf_dir).withColumn("points", F.transform("embedding", lambda x: x.cast("double") * 100))
    back = tracks.decode_points(tracks.encode_points(d, ["label"], "frame", "points"), ["label"], "frame", "back", 64)
    off = F.array_max(F.zip_with("points", "back", lambda a, b: F.abs(a - b)))
    return d.join(back, ["label", "frame"], "left").select("label", "vec_id", F.coalesce(off <= 1.0, F.lit(False)).alias("near"))


@query(EVENTS + f""", m AS (SELECT user_id, CAST(round(t * 1000) AS BIGINT) AS ms FROM ev), g AS (SELECT user_id, ms, ms - lag(ms) OVER w AS gap, row_number() OVER w AS k FROM m WINDOW w AS (PARTITION BY user_id ORDER BY ms)),
c AS (SELECT user_id, gap, count(*) AS n FROM g WHERE gap IS NOT NULL GROUP BY 1, 2), s AS (SELECT user_id, arg_min(gap, (-n, gap)) AS step FROM c GROUP BY 1),
v AS (SELECT user_id, k, ms, coalesce(step, 0) AS step, CASE WHEN gap - step < 0 THEN -2 * (gap - step) + 1 ELSE 2 * (gap - step) END AS v FROM g LEFT JOIN s USING (user_id)),
d AS (SELECT user_id, k, ms, step, CASE WHEN v IS NULL THEN '' ELSE array_to_string(list_transform(range(0, CAST(ceil(length(bin(v)) / 5) AS BIGINT)), lambda i: substr('{DIGITS}', CAST((v // CAST(pow(32, i) AS BIGINT)) % 32 + CASE WHEN i < CAST(ceil(length(bin(v)) / 5) AS BIGINT) - 1 THEN 32 ELSE 0 END + 1 AS BIGINT), 1)), '') END AS x FROM v)
SELECT user_id, min(ms) AS first, any_value(step) AS step, count(*) AS n, string_agg(x, '' ORDER BY k) AS data FROM d GROUP BY 1""")
def event_time_codes(spark, sf_dir):
    """The times of each user's events as the commonest gap and what gaps differ from it."""
    return tracks.encode_times(timed_events(spark, sf_dir), ["user_id"], "t").drop("chunk")


@query("SELECT user_id, CAST(round((epoch_us(ts) - 1704067200000000) / 1e6 * 1000) AS BIGINT) AS ms FROM events")
def event_times_again(spark, sf_dir):
    coded = tracks.encode_times(timed_events(spark, sf_dir), ["user_id"], "t", most=16)
    return tracks.decode_times(coded, ["user_id"]).select("user_id", "ms")


def tasks(spark, sf_dir):
    """Events as tasks of six-day parts of each user: a part's tasks end half a day after it at the latest."""
    part = F.floor(F.col("t") / (6 * DAY)).cast("int")
    end = F.least(F.col("t") + F.col("value") * 600, (part + 1) * 6 * DAY + DAY / 2)
    early = timed_events(spark, sf_dir).withColumn("back", F.when(F.col("t") % (6 * DAY) < DAY / 2, DAY / 2).otherwise(0.0))
    return early.select("user_id", part.alias("part"), F.col("event_id").alias("id"), (F.col("t") - F.col("back")).alias("s"), end.alias("e"), (F.col("event_type") != "purchase").alias("open"))


@query()
def joined_tasks(spark, sf_dir):
    """Tasks joined across the cuts of a user's parts; every third cut has no shared window but a verdict."""
    d = tasks(spark, sf_dir)
    cut = F.col("part") * 6 * DAY
    seam = F.col("part") % 3 == 2
    cuts = d.where("part > 0").select("user_id", "part").distinct().withColumns({"w0": F.when(~seam, cut - DAY / 2), "w1": F.when(~seam, cut + DAY / 2), "cut": cut, "same": F.when(seam, F.col("user_id") % 2 == 0)})
    got = seams.join_across_cuts(d, cuts, ["user_id"], "part", "id", "s", "e", "open")
    whole = seams.whole_tasks(d, got, "id", "s", "e")
    return whole.select("root", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"), F.size("halves").cast("long").alias("halves"))


def nested_orders(spark, sf_dir):
    """Orders as one nested value: status, customer and lines in their order."""
    both = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    customer = F.struct(F.col("o_custkey").alias("key"), F.when(F.col("o_custkey") % 2 == 0, F.col("o_orderpriority")).alias("token"))
    line = lambda x: F.struct(x["l_linenumber"].alias("n"), F.struct(x["l_partkey"].alias("key"), x["l_returnflag"].alias("flag")).alias("part"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_returnflag"))), line)
    o = F.struct(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"), customer.alias("customer"), lines.alias("lines"))
    return both.groupBy("o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority").agg(o.alias("o"))


@query("""WITH b AS (SELECT * FROM orders JOIN lineitem ON o_orderkey = l_orderkey), o AS (SELECT o_orderkey, any_value(o_custkey) AS c, count(*) AS n FROM b GROUP BY 1), m AS (SELECT max(n) - 1 AS place, count(*) AS n, count(*) FILTER (c % 2 = 0) AS even FROM o), l AS (SELECT count(*) AS n FROM b)
SELECT 'key' AS field, 'integer' AS kinds, n, 0::BIGINT AS nulls, 1 AS depth, NULL::BIGINT AS place FROM m UNION ALL SELECT 'status', 'string', n, 0, 1, NULL FROM m UNION ALL SELECT 'customer.key', 'integer', n, 0, 2, NULL FROM m
UNION ALL SELECT 'customer.token', 'string', even, 0, 2, NULL FROM m UNION ALL SELECT 'lines[].n', 'integer', l.n, 0, 3, m.place FROM l, m UNION ALL SELECT 'lines[].part.key', 'integer', l.n, 0, 4, m.place FROM l, m UNION ALL SELECT 'lines[].part.flag', 'string', l.n, 0, 4, m.place FROM l, m""")
def nested_fields(spark, sf_dir):
    """The fields of orders as JSON documents: kinds, how often, how deep."""
    found = documents.leaves(nested_orders(spark, sf_dir), ["o_orderkey"], F.to_json("o"))
    return documents.field_types(found).withColumn("kinds", F.array_join("kinds", ","))


@query("""WITH b AS (SELECT o_orderkey, o_custkey, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)
SELECT o_orderkey, 2 + CASE WHEN o_custkey % 2 = 0 THEN 1 ELSE 0 END + greatest(n - 1, 0) * 3 AS uncovered FROM b""")
def uncovered_fields(spark, sf_dir):
    """How many values of each order nothing stands for when its status and first line are known."""
    found = documents.leaves(nested_orders(spark, sf_dir), ["o_orderkey"], F.to_json("o"))
    known = spark.createDataFrame([("/status",), ("/lines/0",)], "pointer string")
    return documents.uncovered(found, known).groupBy("o_orderkey").agg(F.count("*").alias("uncovered"))


@query("""SELECT o_orderkey, any_value(o_custkey) AS customer, array_to_string(list(CASE WHEN l_returnflag = 'R' THEN '[withheld]' ELSE l_returnflag END ORDER BY l_linenumber, l_partkey, l_returnflag), ',') AS flags FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
def withheld_values(spark, sf_dir):
    """Nested orders without tokens and keys of parts, one flag withheld wherever it stands."""
    d = nested_orders(spark, sf_dir).select("o_orderkey", "o")
    kept = documents.rewritten_rows(d, lambda path, name: name == "token" or path == "o.lines[].part.key", lambda path, v: F.when(v == "R", documents.WITHHELD).otherwise(v))
    return kept.select("o_orderkey", F.col("o.customer.key").alias("customer"), F.array_join(F.transform("o.lines", lambda x: x["part"]["flag"]), ",").alias("flags"))


def written_frames(spark, sf_dir):
    """Events as frames of recordings in files of many users each."""
    frame = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    path = new_folder(spark, "frames")
    d = table(spark, sf_dir, "events").select("user_id", frame.alias("frame"), "event_id", "value", "props")
    d.repartitionByRange("user_id").sortWithinPartitions("user_id", "frame").write.parquet(path)
    return path, index.recording_index(spark.read.parquet(path), "user_id", "frame")


@query("SELECT user_id, count(*) AS n, CAST(NULL AS VARCHAR) AS problem FROM events GROUP BY 1")
def recording_index(spark, sf_dir):
    """Recordings as an index of their files tells them, with what is wrong with their frames."""
    return index.recordings(written_frames(spark, sf_dir)[1], "user_id").select("user_id", "n", "problem")


@query("SELECT user_id, event_id, round(value, 6) AS value FROM events WHERE user_id IN (SELECT user_id FROM events GROUP BY 1 HAVING max(value) > (SELECT 0.9 * max(value) FROM events))")
def recordings_asked_for(spark, sf_dir):
    """The frames of the users with a value near the greatest, read from their files alone."""
    path, ix = written_frames(spark, sf_dir)
    e = table(spark, sf_dir, "events")
    most = e.agg((F.max("value") * 0.9).alias("most"))
    asked = e.groupBy("user_id").agg(F.max("value").alias("v")).join(F.broadcast(most), F.col("v") > F.col("most")).select("user_id")
    return index.read_recordings(spark, path, ix, "user_id", asked, ["user_id", "event_id", "value"]).withColumn("value", F.round("value", 6))


@query("""SELECT l_partkey AS code, CASE WHEN count(DISTINCT l_returnflag) = 1 THEN min(l_returnflag) END AS label, CASE WHEN count(DISTINCT l_returnflag) > 1 THEN 'conflicting rows' END AS why, count(*) AS rows FROM lineitem GROUP BY 1""")
def table_labels(spark, sf_dir):
    """What lines say of each part as a recorded code: one label where all agree."""
    return index.table_labels(table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("code"), "l_returnflag"), "code", ["l_returnflag"])


WORDS = "WITH w AS (SELECT DISTINCT lower(w) AS r FROM (SELECT unnest(regexp_extract_all(text, '\\p{L}+')) AS w FROM conversations) WHERE length(w) >= 5)"


@query(WORDS + """, k AS (SELECT r, unnest(range(1, length(r))) AS k FROM w), s AS (SELECT DISTINCT substr(r, 1, k - 1) || substr(r, k + 1, 1) || substr(r, k, 1) || substr(r, k + 2) AS wrong FROM k), x AS (SELECT wrong FROM s ANTI JOIN w ON wrong = r),
p AS (SELECT doc_id, unnest(regexp_extract_all(text, '\\p{L}+')) AS p FROM documents) SELECT doc_id, count(*) AS swaps FROM p JOIN x ON lower(p) = wrong WHERE length(p) >= 4 GROUP BY 1""")
def swapped_words(spark, sf_dir):
    """Documents with words that two swapped letters keep from being words of the conversations."""
    words = table(spark, sf_dir, "conversations").select(F.explode(F.regexp_extract_all("text", F.lit("\\p{L}+"), F.lit(0))).alias("w")).where(F.length("w") >= 5)
    d = index.spelled(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", words, "w")
    return d.where("swaps > 0").select("doc_id", "swaps")


@query(EVENTS.replace("WITH ev", "WITH RECURSIVE ev") + """, n AS (SELECT user_id, count(*) AS n FROM ev GROUP BY 1), h(user_id, lo, hi, depth) AS (SELECT user_id, 0, n - 1, 1 FROM n UNION ALL SELECT user_id, CASE WHEN side = 0 THEN lo ELSE (lo + hi) // 2 + 1 END, CASE WHEN side = 0 THEN (lo + hi) // 2 - 1 ELSE hi END, depth + 1 FROM h, (VALUES (0), (1)) v(side) WHERE CASE WHEN side = 0 THEN lo <= (lo + hi) // 2 - 1 ELSE (lo + hi) // 2 + 1 <= hi END),
k AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM ev)
SELECT k.user_id, event_id, CAST(row_number() OVER (PARTITION BY k.user_id ORDER BY depth, i) AS INTEGER) AS turn FROM k JOIN h ON k.user_id = h.user_id AND i = (lo + hi) // 2""")
def spread_turns(spark, sf_dir):
    """Each user's events in the order in which those far apart come first."""
    return sampling.spread_turns(table(spark, sf_dir, "events").select("user_id", "event_id"), "user_id", ["event_id"])


@query()
def spread_sample(spark, sf_dir):
    """Orders of all customers in turn, spread over each one's, until they make up a tenth of the whole price."""
    o = table(spark, sf_dir, "orders")
    target = (o.agg(F.sum("o_totalprice")).first()[0] or 0.0) / 10
    return sampling.sampled_to_target(o, "o_custkey", ["o_orderkey"], "o_totalprice", target).select("o_orderkey", "turn")


@query("""WITH e AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS j, CAST(embedding[1] AS DOUBLE) AS x FROM embeddings), s AS (SELECT label, j, x, sum(x) OVER (PARTITION BY label ORDER BY j) AS c, count(*) OVER (PARTITION BY label) AS n FROM e),
a AS (SELECT label, j AS frame, least(greatest((j * 7) // 10 - 1, 0), n) AS pl, n FROM s), m AS (SELECT a.label, frame, pl, coalesce(c, 0) AS c FROM a LEFT JOIN s ON a.label = s.label AND s.j = pl - 1),
d AS (SELECT label, frame, pl, c, lead(pl) OVER w AS na, lead(c) OVER w AS nc FROM m WINDOW w AS (PARTITION BY label ORDER BY frame)) SELECT label, frame, round(CASE WHEN na > pl THEN nc - c END, 6) AS change FROM d WHERE na IS NOT NULL""")
def changes_on_anchor(spark, sf_dir):
    """A component's steps summed between the frames that a slower anchor shows."""
    d = frames(spark, sf_dir)
    own = d.select("label", F.col("frame").alias("j"), F.col("embedding")[0].cast("double").alias("x"))
    anchor = d.select("label", "frame", (F.floor(F.col("frame") * 7 / 10) - 1).alias("shown"))
    return clocks.onto_anchor(anchor, own, ["label"], "frame", "shown", "j", "x").withColumn("change", F.round("change", 6))


@query(EVENTS + """, p AS (SELECT user_id, t, value AS ml, lag(value) OVER w AS mr, value * 2 + CASE WHEN event_type = 'view' THEN 30 ELSE 0 END AS vr, lag(value) OVER w + 1 AS vl FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
c AS (SELECT user_id, corr(ml, vl) AS ll, corr(mr, vr) AS rr, corr(ml, vr) AS lr, corr(mr, vl) AS rl FROM p WHERE vl IS NOT NULL GROUP BY 1), f AS (SELECT user_id, corr(ml, vr) AS lr FROM p GROUP BY 1)
SELECT user_id, round(ll, 6) AS left_left, round(f.lr, 6) AS left_right, least(f.lr, rl) > greatest(ll, rr) AS crossed FROM c JOIN f USING (user_id)""")
def crossed_streams(spark, sf_dir):
    """Whether two made streams of each user follow each other's actor: here they do."""
    w = Window.partitionBy("user_id").orderBy("event_id")
    d = timed_events(spark, sf_dir).withColumns({"ml": F.col("value"), "mr": F.lag("value").over(w), "vr": F.col("value") * 2 + F.when(F.col("event_type") == "view", 30).otherwise(0)}).withColumn("vl", F.col("mr") + 1)
    r = clocks.crossed(d, ["user_id"], ("ml", "mr"), ("vl", "vr"))
    return r.select("user_id", F.round("left_left", 6).alias("left_left"), F.round("left_right", 6).alias("left_right"), "crossed")


@query("""WITH o AS (SELECT o_custkey, o_orderkey, epoch(o_orderdate) / 86400 AS d FROM orders), f AS (SELECT DISTINCT o_custkey, d FROM o WHERE o_orderkey % 2 = 0), i AS (SELECT o_custkey, o_orderkey, d AS t FROM o WHERE o_orderkey % 2 = 1),
e AS (SELECT o_custkey, min(d) AS lo, max(d) AS hi FROM f GROUP BY 1), n AS (SELECT o_orderkey, arg_min(f.d, (abs(f.d - t), f.d)) AS pl, min(abs(f.d - t)) AS off FROM i JOIN f USING (o_custkey) GROUP BY 1)
SELECT i.o_orderkey, CASE WHEN pl IS NULL THEN 'refused' WHEN off <= 30 THEN 'placed' WHEN t BETWEEN lo AND hi THEN 'far' ELSE 'refused' END AS fate, CAST(CASE WHEN off <= 30 OR t BETWEEN lo AND hi THEN pl END AS BIGINT) AS day FROM i LEFT JOIN n USING (o_orderkey) LEFT JOIN e USING (o_custkey)""")
def labels_on_frames(spark, sf_dir):
    """Odd orders placed on the days of the customer's even ones, a month off at most."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (F.unix_micros(F.col("o_orderdate").cast("timestamp")) / 86400e6).alias("t"))
    days = o.where("o_orderkey % 2 = 0").select("o_custkey", F.col("t").alias("ts")).distinct()
    d = exports.snapped(o.where("o_orderkey % 2 = 1"), days, ["o_custkey"], "t", "ts", 30.0)
    return d.select("o_orderkey", "fate", F.col("at").cast("long").alias("day"))


@query("""WITH v AS (SELECT label, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v, lag(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) OVER (PARTITION BY label ORDER BY vec_id) AS w FROM embeddings),
d AS (SELECT label, vec_id, list_transform(list_zip(v, w), lambda p: p[1] - p[2]) AS d FROM v WHERE w IS NOT NULL)
SELECT label, vec_id, len(list_filter(d, lambda x: abs(x) > 0.2)) AS changed, len(list_filter(d, lambda x: x > 0.2)) AS rising, round(list_avg(d), 6) AS mean_change, round(list_aggregate(list_transform(d, lambda x: abs(x)), 'quantile_cont', 0.5), 6) AS median, round(list_aggregate(list_transform(d, lambda x: abs(x)), 'quantile_cont', 0.9), 6) AS p90, round(list_sum(list_transform(d, lambda x: abs(x))), 6) AS moved FROM d""")
def array_changes(spark, sf_dir):
    """How the components of each frame differ from those of the one before."""
    d = frames(spark, sf_dir)
    c = summaries.instant_changes(d, ["label"], "vec_id", "embedding", F.lit(True), 0.2).where("change is not null")
    moved = summaries.row_steps(d, ["label"], "vec_id", "embedding").withColumn("moved", F.round("moved", 6))
    r = lambda n: F.round(f"change.{n}", 6).alias(n)
    return c.select("label", "vec_id", "change.changed", "change.rising", r("mean_change"), r("median"), r("p90")).join(moved, ["label", "vec_id"])


@query()
def spaced_peaks(spark, sf_dir):
    """The greatest values of each user, none within a day of a greater one, ten at most."""
    return summaries.spaced_peaks(timed_events(spark, sf_dir), ["user_id"], "t", "value", DAY, 10).select("user_id", "event_id")


@query(EVENTS + """, p AS (SELECT user_id, event_id, t, value AS a, CASE WHEN event_type = 'purchase' THEN value * 5 ELSE value * 2 + 3 END AS b FROM ev), f AS (SELECT user_id, regr_slope(b, a) AS s, regr_intercept(b, a) AS i, count(*) AS n FROM p GROUP BY 1)
SELECT user_id, event_id, coalesce(n >= 10 AND abs(b - (s * a + i)) <= 0.2 * abs(s * a + i), false) AS observed FROM p JOIN f USING (user_id)""")
def agreeing_rows(spark, sf_dir):
    """Events whose second value lies near the line that the first one foretells it by."""
    b = F.when(F.col("event_type") == "purchase", F.col("value") * 5).otherwise(F.col("value") * 2 + 3)
    d = summaries.agreeing_rows(timed_events(spark, sf_dir).withColumn("b", b), ["user_id"], "event_id", "t", "value", "b", 0.2)
    return d.select("user_id", "event_id", "observed")

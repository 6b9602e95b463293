"""Queries over fixed-width vectors and numeric expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.functions import numbers as nm, text as tx
from spanloom.plans.registry import query, table


def long_form(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("i", "x")).withColumn("x", F.col("x").cast("double"))


LONG = "WITH l AS (SELECT vec_id, label, CAST(i - 1 AS INTEGER) AS i, CAST(embedding[i] AS DOUBLE) AS x FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings))"


@query(LONG + " SELECT i, round(min(x), 6) AS least, round(max(x), 6) AS most, round(max(x) - min(x), 6) AS range, max(x) = min(x) AS constant, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS spread FROM l GROUP BY 1")
def column_ranges(spark, sf_dir):
    ok = tx.stored_number(F.col("x"))
    d = long_form(spark, sf_dir).withColumn("x", ok).groupBy("i")
    return d.agg(F.round(F.min("x"), 6).alias("least"), F.round(F.max("x"), 6).alias("most"), F.round(F.max("x") - F.min("x"), 6).alias("range"), (F.max("x") == F.min("x")).alias("constant"), F.round(F.avg("x"), 6).alias("mean"), F.round(F.stddev_pop("x"), 6).alias("spread"))


@query(LONG + ", c AS (SELECT label, i, avg(x) AS m FROM l GROUP BY 1, 2) SELECT vec_id, l.label, round(sqrt(sum((x - m) * (x - m))), 6) AS distance FROM l JOIN c ON l.label = c.label AND l.i = c.i GROUP BY 1, 2")
def centroid_distance(spark, sf_dir):
    centres = long_form(spark, sf_dir).groupBy("label", "i").agg(F.avg("x").alias("m")).groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "m"))).alias("c"))
    centres = centres.select("label", F.transform("c", lambda p: p["m"]).alias("m"))
    d = table(spark, sf_dir, "embeddings").join(centres, "label")
    v = F.transform("embedding", lambda x: x.cast("double"))
    return d.select("vec_id", "label", F.round(nm.distance(v, F.col("m")), 6).alias("distance"))


@query(LONG + ", q AS (SELECT i, 10 * quantile_cont(abs(x), 0.5) AS t FROM l GROUP BY 1) SELECT i, count(*) FILTER (abs(x) > 0.2 * t) AS active, round(avg(CASE WHEN x > 0 THEN 1.0 ELSE 0.0 END), 6) AS positive FROM l JOIN q USING (i) GROUP BY 1")
def component_activity(spark, sf_dir):
    d = long_form(spark, sf_dir)
    q = d.groupBy("i").agg((10 * F.percentile(F.abs("x"), 0.5)).alias("t"))
    return d.join(q, "i").groupBy("i").agg(F.count_if(F.abs("x") > 0.2 * F.col("t")).alias("active"), F.round(F.avg((F.col("x") > 0).cast("double")), 6).alias("positive"))


@query(LONG + ", p AS (SELECT i, x - lag(x) OVER (PARTITION BY i ORDER BY vec_id) AS d, vec_id FROM l) SELECT vec_id, count(*) FILTER (d > 0.1) AS rising, count(*) FILTER (d < -0.1) AS falling, round(sum(abs(d)), 6) AS moved FROM p WHERE d IS NOT NULL GROUP BY 1")
def component_change(spark, sf_dir):
    """Each vector against the one before it, component by component."""
    from pyspark.sql import Window

    d = long_form(spark, sf_dir).withColumn("d", F.col("x") - F.lag("x").over(Window.partitionBy("i").orderBy("vec_id"))).where("d is not null")
    return d.groupBy("vec_id").agg(F.count_if(F.col("d") > 0.1).alias("rising"), F.count_if(F.col("d") < -0.1).alias("falling"), F.round(F.sum(F.abs("d")), 6).alias("moved"))


@query("""WITH b AS (SELECT label, min(CAST(embedding[1] AS DOUBLE)) AS lo, max(CAST(embedding[1] AS DOUBLE)) AS hi FROM embeddings GROUP BY 1)
SELECT vec_id, CAST(round_even((CAST(embedding[1] AS DOUBLE) - lo) / ((hi - lo) / 254), 0) AS BIGINT) AS code FROM embeddings JOIN b USING (label)""")
def quantise_component(spark, sf_dir):
    d = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding")[0].cast("double").alias("x"))
    b = d.groupBy("label").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    return d.join(b, "label").select("vec_id", nm.quantised(F.col("x"), F.col("lo"), F.col("hi"), 8).alias("code"))


@query("""WITH e AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS a, CAST(embedding[2] AS DOUBLE) AS b, CAST(embedding[3] AS DOUBLE) AS c, CAST(embedding[4] AS DOUBLE) AS d FROM embeddings), q AS (SELECT vec_id, a / n AS x, b / n AS y, c / n AS z, d / n AS w FROM (SELECT *, sqrt(a*a + b*b + c*c + d*d) AS n FROM e))
SELECT vec_id, round(atan2(2 * (w*x + y*z), 1 - 2 * (x*x + y*y)), 6) AS roll, round(asin(greatest(-1.0, least(1.0, 2 * (w*y - z*x)))), 6) AS pitch, round(atan2(2 * (w*z + x*y), 1 - 2 * (y*y + z*z)), 6) AS yaw FROM q""")
def quaternion_angles(spark, sf_dir):
    """The first four components as a rotation."""
    d = table(spark, sf_dir, "embeddings").select("vec_id", *(F.col("embedding")[k].cast("double").alias(n) for k, n in enumerate("abcd")))
    n = F.sqrt(sum((F.col(c) * F.col(c) for c in "abcd"), F.lit(0.0)))
    r = nm.quaternion_to_rpy(*(F.col(c) / n for c in "abcd"))
    return d.select("vec_id", *(F.round(r[k], 6).alias(x) for k, x in enumerate(("roll", "pitch", "yaw"))))


@query("""SELECT o_orderkey, CAST(floor(o_totalprice / 60) AS BIGINT) || ':' || lpad(CAST(CAST(floor(o_totalprice - 60 * floor(o_totalprice / 60)) AS BIGINT) AS VARCHAR), 2, '0') AS clock, round(o_totalprice / 1000, 1) AS tenths FROM orders""")
def clock_text(spark, sf_dir):
    p = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select("o_orderkey", tx.clock(p).alias("clock"), tx.tenths(p / 1000).alias("tenths"))


@query("""SELECT o_orderkey, TRY_CAST(CASE WHEN regexp_matches(x, '^[0-9]+(\\.[0-9]*)?s?$') THEN rtrim(x, 's') END AS DOUBLE) AS v FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_orderkey || '.5s' WHEN 1 THEN CAST(o_orderkey AS VARCHAR) WHEN 2 THEN o_orderpriority END AS x FROM orders)""")
def parse_numbers(spark, sf_dir):
    n = F.col("o_orderkey")
    x = F.when(n % 4 == 0, F.concat(n.cast("string"), F.lit(".5s"))).when(n % 4 == 1, n.cast("string")).when(n % 4 == 2, F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select("o_orderkey", tx.number(x).alias("v"))


@query("""SELECT o_orderkey, array_to_string(list_sort(list_distinct(list_transform(range(0, 5), lambda i: CAST(floor(i * (o_orderkey + 9) / 4.0) AS INTEGER)))), ',') AS places FROM orders""")
def spread_places(spark, sf_dir):
    """Five places evenly spread over n + 10 rows."""
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(nm.spread_places((F.col("o_orderkey") + 10).cast("int"), 5), ",").alias("places"))


ANGLES = "WITH e AS (SELECT vec_id, " + ", ".join(f"CAST(embedding[{k + 1}] AS DOUBLE) AS a{k}" for k in range(6)) + " FROM embeddings)"


def entries(r: str, p: str, y: str) -> list[str]:
    cr, sr, cp, sp, cy, sy = (f"{f}({v})" for v in (r, p, y) for f in ("cos", "sin"))
    return [f"{cy}*{cp}", f"({cy}*{sp}*{sr}-{sy}*{cr})", f"({cy}*{sp}*{cr}+{sy}*{sr})", f"{sy}*{cp}", f"({sy}*{sp}*{sr}+{cy}*{cr})", f"({sy}*{sp}*{cr}-{cy}*{sr})", f"(-{sp})", f"{cp}*{sr}", f"{cp}*{cr}"]


@query(ANGLES + " SELECT vec_id, round(degrees(acos(greatest(-1.0, least(1.0, (" + " + ".join(f"{x}*{y}" for x, y in zip(entries("a0", "a1", "a2"), entries("a3", "a4", "a5"))) + " - 1) / 2)))), 5) AS turn FROM e")
def turn_between(spark, sf_dir):
    """The angle between two rotations given by roll, pitch and yaw."""
    a = [F.col("embedding")[k].cast("double") for k in range(6)]
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(nm.turn_degrees(nm.rotation(*a[:3]), nm.rotation(*a[3:])), 5).alias("turn"))


@query(LONG + """, b AS (SELECT i, min(x) AS lo, max(x) AS hi FROM l GROUP BY 1), q AS (SELECT vec_id, x, lo + CAST(round_even((x - lo) / ((hi - lo) / 254), 0) AS BIGINT) * (hi - lo) / 254 AS r FROM l JOIN b USING (i))
SELECT vec_id, round(sqrt(sum((x - r) * (x - r))), 6) AS lost, round(sum(x * r), 6) AS product FROM q GROUP BY 1""")
def quantised_loss(spark, sf_dir):
    """What 8-bit codes of each component lose: distance and product of vectors and their restored forms."""
    d = long_form(spark, sf_dir)
    b = d.groupBy("i").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    code = nm.quantised(F.col("x"), F.col("lo"), F.col("hi"), 8)
    q = d.join(b, "i").withColumn("r", nm.restored(code, F.col("lo"), F.col("hi"), 8))
    v = q.groupBy("vec_id").agg(F.sort_array(F.collect_list(F.struct("i", "x", "r"))).alias("p"))
    x, r = F.transform("p", lambda e: e["x"]), F.transform("p", lambda e: e["r"])
    return v.select("vec_id", F.round(nm.distance(x, r), 6).alias("lost"), F.round(nm.dot(x, r), 6).alias("product"))

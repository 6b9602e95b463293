"""Queries over pages and conversations: parts of URLs and pages, ordered turns, nested rows."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from spanloom.functions import text as tx
from spanloom.operators import records, sequences as seq
from spanloom.plans.registry import micros, query, table


@query("""SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '://([^/?#]+)', 1) AS host, regexp_extract(url, '://[^/?#]+([^?#]*)', 1) AS path, CASE WHEN contains(url, '?') THEN regexp_extract(url, '\\?([^#]*)', 1) END AS query FROM pages""")
def url_parts(spark, sf_dir):
    u = F.col("url")
    part = lambda p: F.parse_url(u, F.lit(p))
    return table(spark, sf_dir, "pages").select("page_id", part("PROTOCOL").alias("scheme"), part("HOST").alias("host"), F.coalesce(part("PATH"), F.lit("")).alias("path"), part("QUERY").alias("query"))


@query("""SELECT page_id, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang FROM pages""")
def title_extract(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.trim(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"), F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("lang"))


@query("""WITH t AS (SELECT page_id, unnest(regexp_extract_all(html, '<([a-z][a-z0-9]*)', 1)) AS tag FROM pages) SELECT tag, count(*) AS n, count(DISTINCT page_id) AS pages FROM t GROUP BY 1""")
def tag_counts(spark, sf_dir):
    d = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit("<([a-z][a-z0-9]*)"), F.lit(1))).alias("tag"))
    # Counted per page first, so that the common tags do not meet row by row.
    per_page = d.groupBy("tag", "page_id").count()
    return per_page.groupBy("tag").agg(F.sum("count").alias("n"), F.count("*").alias("pages"))


@query("""SELECT page_id, regexp_matches(lower(regexp_extract(url, '://([^/?#]+)', 1)), '^(localhost|127\\.|10\\.|192\\.168\\.|169\\.254\\.|172\\.(1[6-9]|2[0-9]|3[01])\\.)') OR regexp_matches(lower(regexp_extract(url, '://([^/?#]+)', 1)), '\\.(internal|local|lan|corp)$') AS private FROM pages""")
def private_url_flag(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tx.private_host(F.parse_url("url", F.lit("HOST"))).alias("private"))


@query("""WITH r AS (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS g FROM conversations)
SELECT conv_id, role, min(turn) AS s, max(turn) AS e, count(*) AS n FROM r GROUP BY conv_id, role, g""")
def role_alternation_islands(spark, sf_dir):
    return seq.spans(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", "role").drop("run")


@query("""SELECT conv_id, md5(string_agg(role || ': ' || text, chr(10) ORDER BY turn)) AS stitched, count(*) AS turns FROM conversations GROUP BY 1""")
def stitch_text(spark, sf_dir):
    parts = F.sort_array(F.collect_list(F.struct("turn", F.concat("role", F.lit(": "), "text").alias("x"))))
    d = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(parts.alias("p"), F.count("*").alias("turns"))
    return d.select("conv_id", F.md5(F.array_join(F.transform("p", lambda p: p["x"]), "\n")).alias("stitched"), "turns")


@query("""WITH k AS (SELECT * FROM conversations WHERE (conv_id + turn) % 5 <> 2), m AS (SELECT conv_id, max(turn) AS m FROM k GROUP BY 1),
e AS (SELECT conv_id, unnest(range(0, m + 1)) AS turn FROM m) SELECT e.conv_id, e.turn FROM e LEFT JOIN k ON e.conv_id = k.conv_id AND e.turn = k.turn WHERE k.turn IS NULL""")
def parts_missing(spark, sf_dir):
    """With some turns taken out, the gaps that show."""
    k = table(spark, sf_dir, "conversations").where("(conv_id + turn) % 5 <> 2").select("conv_id", "turn")
    due = k.groupBy("conv_id").agg(F.max("turn").alias("m")).select("conv_id", F.explode(F.sequence(F.lit(0).cast("long"), "m")).alias("turn"))
    return due.join(k, ["conv_id", "turn"], "left_anti")


@query("""SELECT conv_id, arg_max(text, turn) AS text, max(turn) AS turn FROM conversations WHERE role = 'assistant' GROUP BY 1""")
def last_wins(spark, sf_dir):
    d = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    return d.groupBy("conv_id").agg(F.max_by("text", "turn").alias("text"), F.max("turn").alias("turn"))


@query("""WITH r AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS source_row, role, text FROM conversations),
b AS (SELECT conv_id, source_row, list_filter([CASE WHEN role NOT IN ('user', 'assistant') THEN 'role:enum' END, CASE WHEN length(text) > 400 THEN 'text:too_long' END, CASE WHEN source_row = 0 AND role = 'assistant' THEN 'role:first' END], lambda x: x IS NOT NULL) AS d FROM r)
SELECT conv_id, CAST(source_row AS INTEGER) AS source_row, array_to_string(d, ',') AS departures FROM b WHERE len(d) > 0""")
def validate_turns(spark, sf_dir):
    """A conversation as an array of rows, validated with each departure's source row."""
    d = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("items"))

    def rules(x):
        return [
            ("role", "enum", ~x["role"].isin("user", "assistant"), x["role"]),
            ("text", "too_long", F.length(x["text"]) > 400, F.length(x["text"])),
            ("role", "first", (F.col("source_row") == 0) & (x["role"] == "assistant"), x["role"]),
        ]

    long = d.select("conv_id", F.posexplode("items").alias("source_row", "item"))
    long = long.withColumn("d", records.departures(rules(F.col("item")))).where(F.size("d") > 0)
    return long.select("conv_id", "source_row", F.array_join(F.transform("d", lambda x: F.concat(x["field"], F.lit(":"), x["rule"])), ",").alias("departures"))


@query("""SELECT conv_id, CASE WHEN count(*) FILTER (role = 'system') > 0 THEN 'system' WHEN bool_and(role = 'user') THEN 'unclear' ELSE 'plain' END AS kind, string_agg(DISTINCT role, '+' ORDER BY role) AS roles FROM conversations GROUP BY 1""")
def conversation_kind(spark, sf_dir):
    d = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count_if(F.col("role") == "system").alias("n"), F.bool_and(F.col("role") == "user").alias("all_user"), F.array_join(F.array_sort(F.collect_set("role")), "+").alias("roles"))
    return d.select("conv_id", F.when(F.col("n") > 0, "system").when(F.col("all_user"), "unclear").otherwise("plain").alias("kind"), "roles")


@query("""WITH a AS (SELECT conv_id, turn, text, lag(length(text)) OVER w AS b, lead(length(text)) OVER w AS f FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, coalesce(length(text) - b, 0) AS change, coalesce(f, -1) AS following FROM a""")
def turn_changes(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn")
    n = F.length("text")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce(n - F.lag(n).over(w), F.lit(0)).alias("change"), F.coalesce(F.lead(n).over(w), F.lit(-1)).alias("following"))


@query("""SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, json_extract_string(props, '$.absent') AS absent, CAST(len(json_keys(props)) AS INTEGER) AS fields FROM events""")
def open_json(spark, sf_dir):
    """Open documents as VARIANT: typed access, absent fields null, number of fields."""
    v = F.try_parse_json("props")
    d = table(spark, sf_dir, "events").withColumn("v", v)
    return d.select("event_id", F.try_variant_get("v", "$.k", "double").alias("k"), F.try_variant_get("v", "$.absent", "string").alias("absent"), F.size(F.json_object_keys("props")).alias("fields"))


@query("""WITH e AS (SELECT user_id, event_id, '{"t":' || CASE WHEN event_id % 7 = 0 THEN 'null' ELSE CAST(epoch_us(ts) // 1000000 - 1704067200 AS VARCHAR) END || ',"p":' || CASE WHEN event_id % 2 = 0 THEN '"0.' || event_id % 10 || '"' ELSE '0.' || event_id % 10 END || ',"arm":"' || ['LEFT', 'right', 'Both', '?'][event_id % 4 + 1] || '"}' AS s FROM events),
j AS (SELECT user_id, '{"steps":[' || string_agg(s, ',' ORDER BY event_id) || ']}' AS x FROM e GROUP BY 1),
r AS (SELECT user_id, CASE user_id % 4 WHEN 0 THEN x WHEN 1 THEN '```json' || chr(10) || x || chr(10) || '```' WHEN 2 THEN substr(x, 1, length(x) - 2) || '}}' ELSE substr(x, 1, length(x) - 5) END AS reply FROM j),
b AS (SELECT user_id, regexp_replace(trim(reply), '^```(json)?\\s*|\\s*```$', '', 'g') AS b FROM r),
m AS (SELECT user_id, b, list_filter(list_transform(list_filter(range(1, length(b) + 1), lambda i: substr(b, i, 1) IN ('}', ']')), lambda i: substr(b, 1, i - 1) || CASE substr(b, i, 1) WHEN '}' THEN ']' ELSE '}' END || substr(b, i + 1)), lambda y: json_valid(y)) AS mends FROM b WHERE NOT json_valid(b)),
f AS (SELECT b.user_id, CASE WHEN json_valid(b.b) THEN b.b WHEN len(mends) = 1 THEN mends[1] END AS j FROM b LEFT JOIN m USING (user_id)),
s AS (SELECT user_id, unnest(from_json(json_extract(j, '$.steps'), '[{"t":"VARCHAR","p":"VARCHAR","arm":"VARCHAR"}]')) AS s, generate_subscripts(from_json(json_extract(j, '$.steps'), '[{"t":"VARCHAR","p":"VARCHAR","arm":"VARCHAR"}]'), 1) - 1 AS i FROM f WHERE j IS NOT NULL),
t AS (SELECT user_id, i, TRY_CAST(s.t AS DOUBLE) AS t, CAST(round(TRY_CAST(s.p AS DOUBLE) * 10) AS BIGINT) AS p, CASE WHEN lower(s.arm) IN ('left', 'right', 'both') THEN lower(s.arm) ELSE 'unclear' END AS arm FROM s)
SELECT f.user_id, f.j IS NOT NULL AS read, count(t.t) AS steps, count(t.i) - count(t.t) AS dropped, coalesce(md5(string_agg(CAST(CAST(t.t AS BIGINT) AS VARCHAR) || ':' || t.i || ':' || t.p || ':' || arm, ';' ORDER BY t.t, t.i) FILTER (t.t IS NOT NULL)), '') AS timeline FROM f LEFT JOIN t USING (user_id) GROUP BY 1, 2""")
def typed_timelines(spark, sf_dir):
    """Replies with fences, a wrong bracket or a cut, read back as typed, ordered steps."""
    k = F.col("event_id")
    t = F.when(k % 7 == 0, "null").otherwise((F.floor(micros("ts") / 1000000) - 1704067200).cast("string"))
    p = F.concat(F.lit("0."), (k % 10).cast("string"))
    p = F.when(k % 2 == 0, F.concat(F.lit('"'), p, F.lit('"'))).otherwise(p)
    arm = F.get(F.array(*map(F.lit, ["LEFT", "right", "Both", "?"])), (k % 4).cast("int"))
    step = F.concat(F.lit('{"t":'), t, F.lit(',"p":'), p, F.lit(',"arm":"'), arm, F.lit('"}'))
    made = table(spark, sf_dir, "events").select("user_id", "event_id", step.alias("s")).groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("event_id", "s"))).alias("a"))
    x = F.concat(F.lit('{"steps":['), F.array_join(F.transform("a", lambda r: r["s"]), ","), F.lit("]}"))
    u, n = F.col("user_id") % 4, F.length("x")
    reply = F.when(u == 0, F.col("x")).when(u == 1, F.concat(F.lit("```json\n"), "x", F.lit("\n```"))).when(u == 2, F.concat(F.substring("x", F.lit(1), n - 2), F.lit("}}"))).otherwise(F.substring("x", F.lit(1), n - 5))
    d = made.select("user_id", x.alias("x")).select("user_id", records.repaired(reply).alias("j"))
    d = d.withColumn("steps", F.from_json("j", "steps array<struct<t: string, p: string, arm: string>>")["steps"])
    d = d.withColumn("line", F.coalesce(records.timeline(F.col("steps"), ["left", "right", "both"], tx.number), F.array()))
    text = F.array_join(F.transform("line", lambda s: F.concat_ws(":", s["t"].cast("long").cast("string"), s["source_row"].cast("string"), F.round(s["p"] * 10).cast("long").cast("string"), s["arm"])), ";")
    kept = F.size("line").cast("long")
    return d.select("user_id", F.col("j").isNotNull().alias("read"), kept.alias("steps"), (F.coalesce(F.size("steps"), F.lit(0)) - kept).alias("dropped"), F.when(kept > 0, F.md5(text)).otherwise("").alias("timeline"))


@query("""WITH a AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS source_row, role, text FROM conversations)
SELECT conv_id, CAST(source_row AS INTEGER) AS source_row, concat_ws(',', CASE WHEN role NOT IN ('user', 'assistant') THEN 'role' END, CASE WHEN length(text) < 40 THEN 'text' END) AS departures FROM a""")
def checked_items(spark, sf_dir):
    """Every item of a nested record with its source row and what departs from the rules."""
    d = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    out = records.checked_items(d, ["conv_id"], "turns", lambda r: [("role", "enum", ~r["role"].isin("user", "assistant"), r["role"]), ("text", "too_short", F.length(r["text"]) < 40, F.length(r["text"]))])
    return out.select("conv_id", "source_row", F.array_join(F.transform("departures", lambda x: x["field"]), ",").alias("departures"))

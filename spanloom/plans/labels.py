"""Queries over label records, their checks, issues and texts."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from spanloom.functions import text as tx
from spanloom.operators import labels
from spanloom.plans.registry import EVENTS, query, table, timed_events

OUTCOMES = ["success", "success_then_undone", "partial", "failure"]
RELATIONS = ["aligned", "broader", "narrower", "different", "unrelated"]


def pick(names: list[str], k):
    """The k-th name (from 0), null beyond the last."""
    return F.get(F.array(*map(F.lit, names)), k.cast("int"))


def label_records(spark, sf_dir):
    """Orders as label records: outcome, relation, times and the progress of their lines."""
    k = F.col("o_orderkey")
    l = table(spark, sf_dir, "lineitem")
    n = F.count("*").over(Window.partitionBy("l_orderkey"))
    steps = l.withColumns({"t": F.col("l_linenumber") * 10.0, "p": F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber")) / n}).groupBy("l_orderkey").agg(F.max("t").alias("last_change"), F.max("p").alias("peak"), F.min(F.when(F.col("p") >= 1, F.col("t"))).alias("first_full"))
    o = table(spark, sf_dir, "orders").join(steps, k == F.col("l_orderkey"), "left")
    full = k % 4 > 0
    return o.select(
        "o_orderkey", pick(OUTCOMES, k % 5).alias("outcome"), pick(RELATIONS, F.floor(k / 5) % 5).alias("relation"), (k % 3 > 0).alias("matches"),
        F.when(k % 7 > 0, k % 50 * 1.0).alias("goal"), F.when(k % 11 > 0, k % 60 * 1.0 - 2).alias("undone"), F.when(k % 13 > 0, k % 50 + k % 3 * 0.4).alias("done"),
        "last_change", F.when(full, F.col("peak")).otherwise(F.col("peak") * 0.9).alias("peak"), F.when(full, F.col("first_full")).alias("first_full"),
    )


LABELS = """WITH s AS (SELECT l_orderkey, l_linenumber * 10.0 AS t, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) / count(*) OVER (PARTITION BY l_orderkey) AS p FROM lineitem),
g AS (SELECT l_orderkey, max(t) AS last_change, max(p) AS peak, min(t) FILTER (p >= 1) AS first_full FROM s GROUP BY 1),
r AS (SELECT o_orderkey, ['success', 'success_then_undone', 'partial', 'failure'][o_orderkey % 5 + 1] AS outcome, ['aligned', 'broader', 'narrower', 'different', 'unrelated'][(o_orderkey // 5) % 5 + 1] AS relation, o_orderkey % 3 > 0 AS matches,
  CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_orderkey % 50 AS DOUBLE) END AS goal, CASE WHEN o_orderkey % 11 > 0 THEN o_orderkey % 60 - 2.0 END AS undone, CASE WHEN o_orderkey % 13 > 0 THEN o_orderkey % 50 + CAST(o_orderkey % 3 AS DOUBLE) * 0.4 END AS done,
  last_change, CASE WHEN o_orderkey % 4 > 0 THEN peak ELSE peak * 0.9 END AS peak, CASE WHEN o_orderkey % 4 > 0 THEN first_full END AS first_full FROM orders LEFT JOIN g ON o_orderkey = l_orderkey)"""
RULES = {
    "outcome_vs_alignment": "outcome IN ('success', 'success_then_undone') AND relation IN ('different', 'unrelated')",
    "outcome_vs_partial": "outcome IN ('success', 'success_then_undone') AND relation = 'broader'",
    "alignment_vs_match": "relation = 'aligned' AND NOT matches",
    "undone_timing": "outcome = 'success_then_undone' AND (goal IS NULL OR undone IS NULL OR undone <= goal)",
    "nothing_after_goal": "outcome = 'success_then_undone' AND undone > goal AND NOT coalesce(last_change > goal, false)",
    "progress_vs_outcome": "outcome IN ('failure', 'partial', 'unclear') AND peak >= 1 - 1e-9",
    "goal_times_differ": "outcome = 'success' AND abs(goal - done) > 0.5",
    "progress_before_goal": "outcome = 'success' AND first_full < done - 3",
    "progress_past_goal": "outcome = 'success' AND first_full > done + 3 AND relation = 'aligned'",
    "time_past_end": "greatest(coalesce(goal, 0), coalesce(undone, 0), coalesce(done, 0)) > 46",
    "time_before_start": "least(coalesce(goal, 0), coalesce(undone, 0), coalesce(done, 0)) < 0",
}


@query(LABELS + " SELECT o_orderkey, concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in RULES.items()) + ") AS rules FROM r")
def label_contradictions(spark, sf_dir):
    """Fields of a record that contradict each other, by eleven rules."""
    d = label_records(spark, sf_dir)
    c = {x: F.col(x) for x in ("outcome", "relation", "matches", "goal", "undone", "done", "last_change", "peak", "first_full")}
    rules = labels.contradictions(**c, duration=F.lit(45.0), first_goal=F.col("done"), mismatch=F.lit(False))
    return d.select("o_orderkey", F.array_join(rules, ",").alias("rules"))


@query("""WITH t AS (SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'success' WHEN 'R' THEN 'success_then_undone' ELSE 'partial' END AS outcome, ['instruction', 'subtask', 'goal'][l_partkey % 3 + 1] AS against, ['aligned', 'broader', 'narrower', 'different', 'unrelated'][l_suppkey % 5 + 1] AS relation,
  CASE WHEN l_quantity > 5 THEN l_quantity END AS goal, CASE WHEN l_discount > 0.01 THEN l_quantity + l_discount * 100 - 5 END AS undone FROM lineitem)
SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN outcome IN ('success', 'success_then_undone') AND relation IN ('different', 'unrelated') AND against <> 'goal' THEN 'task_outcome_vs_alignment' END, CASE WHEN outcome = 'success_then_undone' AND (goal IS NULL OR undone IS NULL OR undone <= goal) THEN 'task_undone_timing' END) AS rules FROM t""")
def task_contradictions(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    outcome = F.when(F.col("l_returnflag") == "A", "success").when(F.col("l_returnflag") == "R", "success_then_undone").otherwise("partial")
    goal, undone = F.when(F.col("l_quantity") > 5, F.col("l_quantity")), F.when(F.col("l_discount") > 0.01, F.col("l_quantity") + F.col("l_discount") * 100 - 5)
    rules = labels.task_contradictions(outcome, pick(["instruction", "subtask", "goal"], F.col("l_partkey") % 3), pick(RELATIONS, F.col("l_suppkey") % 5), goal, undone)
    return l.select("l_orderkey", "l_linenumber", F.array_join(rules, ",").alias("rules"))


def issues(spark, sf_dir):
    """Events as issues of a user and kind, in parts of a day; some untimed, wide or lasting."""
    words = F.when(F.col("event_id") % 97 == 0, "It slips again.").otherwise("It slips.")
    e = timed_events(spark, sf_dir)
    return e.select(
        "user_id", "event_type", "event_id", F.floor(F.col("t") / 86400).alias("part"), F.when(F.col("event_id") % 101 > 0, F.col("t")).alias("s"), (F.col("t") + F.col("value") * 20).alias("e"),
        pick(["low", "medium", "high"], F.col("event_id") % 4).alias("severity"), words.alias("issue"),
    ).withColumn("why", labels.condition(F.col("s"), F.col("e"), F.lit(18000.0), F.col("issue")))


ISSUES = EVENTS + """, i AS (SELECT user_id, event_type, event_id, CAST(floor(t / 86400) AS BIGINT) AS part, CASE WHEN event_id % 101 > 0 THEN t END AS s, t + value * 20 AS e, ['low', 'medium', 'high'][event_id % 4 + 1] AS severity, CASE WHEN event_id % 97 = 0 THEN 'It slips again.' ELSE 'It slips.' END AS issue FROM ev),
c AS (SELECT *, CASE WHEN s IS NULL THEN 'untimed' WHEN e - s >= 9000 THEN 'wide' WHEN regexp_matches(lower(issue), '""" + labels.LASTING + """') THEN 'wording' END AS why FROM i)"""


@query(ISSUES + " SELECT event_id, why FROM c")
def condition_signals(spark, sf_dir):
    return issues(spark, sf_dir).select("event_id", "why")


@query(ISSUES.replace("WITH ev", "WITH RECURSIVE ev") + """, l AS (SELECT a.event_id AS a, b.event_id AS b FROM c a JOIN c b ON a.user_id = b.user_id AND a.event_type = b.event_type AND a.event_id <> b.event_id AND (a.why IS NOT NULL AND b.why IS NOT NULL OR a.s IS NOT NULL AND b.s IS NOT NULL AND a.part <> b.part AND greatest(a.s, b.s) - least(a.e, b.e) <= 15)),
reach(a, b) AS (SELECT event_id, event_id FROM c UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a), g AS (SELECT a AS event_id, min(b) AS "group" FROM reach GROUP BY 1)
SELECT "group", count(*) AS n, array_to_string(list_sort(list_distinct(list(part))), ',') AS parts, round(min(s), 3) AS s, round(max(e) FILTER (s IS NOT NULL), 3) AS e, max(CASE severity WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 ELSE 0 END) AS severity FROM c JOIN g USING (event_id) GROUP BY 1""")
def issue_groups(spark, sf_dir):
    """Issues of a user and kind that are one condition or near each other across parts, as one row each."""
    d = issues(spark, sf_dir)
    of = labels.linked_issues(d, ["user_id", "event_type"], "event_id", "part", "s", "e", "why")
    g = labels.grouped_issues(d, of, "event_id", "part", "s", "e", "severity", "issue")
    rank = F.when(F.col("severity") == "high", 3).when(F.col("severity") == "medium", 2).when(F.col("severity") == "low", 1).otherwise(0)
    return g.select("group", "n", F.array_join("parts", ",").alias("parts"), F.round("s", 3).alias("s"), F.round("e", 3).alias("e"), rank.alias("severity"))


@query("""SELECT l_orderkey, array_to_string(list(l_linenumber ORDER BY CASE WHEN l_linenumber % 3 > 0 THEN l_quantity END NULLS LAST, CASE WHEN l_linenumber % 4 > 0 THEN l_tax END NULLS LAST, l_linenumber), ',') AS lines FROM lineitem GROUP BY 1""")
def chronological(spark, sf_dir):
    """Items of a record in time order: start, then end, untimed ones last."""
    item = F.struct(F.when(F.col("l_linenumber") % 3 > 0, F.col("l_quantity")).alias("s"), F.when(F.col("l_linenumber") % 4 > 0, F.col("l_tax")).alias("e"), F.col("l_linenumber").alias("i"))
    d = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(F.col("l_linenumber").alias("i"), item.alias("x")))).alias("a"))
    items = labels.chronological(F.transform("a", lambda r: r["x"]), "s", "e")
    return d.select("l_orderkey", F.array_join(F.transform(items, lambda r: r["i"]), ",").alias("lines"))


@query("""WITH k AS (SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) AS turn FROM part)
SELECT p_partkey, CAST(turn AS INTEGER) AS turn, CAST(row_number() OVER (PARTITION BY turn ORDER BY p_brand, p_partkey) AS INTEGER) AS place FROM k""")
def interleaved_kinds(spark, sf_dir):
    """Parts listed brand by brand in turn."""
    d = labels.interleaved(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice"), "p_brand", ["p_retailprice", "p_partkey"])
    return d.select("p_partkey", "turn", "place")


@query("""WITH k AS (SELECT p_brand, p_partkey, sum(length(p_name)) OVER w AS used, row_number() OVER w AS k FROM part WHERE contains(lower(p_name), 'e') WINDOW w AS (PARTITION BY p_brand ORDER BY p_name, p_partkey))
SELECT p_brand, p_partkey, CAST(used AS BIGINT) AS used FROM k WHERE used <= 200 OR k = 1""")
def field_page(spark, sf_dir):
    """A page of each brand's parts with a letter in their names, under a budget of bytes."""
    d = table(spark, sf_dir, "part").where(F.contains(F.lower("p_name"), F.lit("e"))).select("p_brand", "p_partkey", "p_name", F.length("p_name").alias("n"))
    return labels.page(d, ["p_brand"], ["p_name", "p_partkey"], "n", 200).select("p_brand", "p_partkey", F.col("used").cast("long").alias("used"))


@query("""WITH e AS (SELECT label, vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
k AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS k, count(*) OVER (PARTITION BY label) AS n, vec_id IN (arg_min(vec_id, x) OVER p, arg_max(vec_id, x) OVER p, arg_min(vec_id, y) OVER p, arg_max(vec_id, y) OVER p) AS peak FROM e WINDOW p AS (PARTITION BY label)),
r AS (SELECT *, CASE WHEN k = 1 OR k = n THEN 0 WHEN peak THEN 1 WHEN coalesce(lag(peak) OVER w, false) OR coalesce(lead(peak) OVER w, false) THEN 2 WHEN floor((k - 1) * 24 / n) <> floor((k - 2) * 24 / n) THEN 3 ELSE 4 END AS rank FROM k WINDOW w AS (PARTITION BY label ORDER BY vec_id)),
o AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY rank, vec_id) AS place FROM r)
SELECT label, vec_id, ['end', 'peak', 'neighbour', 'spread', 'rest'][rank + 1] AS why FROM o WHERE place <= 24""")
def recording_outline(spark, sf_dir):
    """At most 24 frames of a recording: ends, extrema of two values, their neighbours, an even spread."""
    d = table(spark, sf_dir, "embeddings").select("label", "vec_id", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    return labels.outline(d, ["label"], "vec_id", ["x", "y"], 24).select("label", "vec_id", "why")


@query("""WITH t AS (SELECT conv_id, list(text ORDER BY turn) AS a FROM conversations GROUP BY 1), n AS (SELECT *, len(list_filter(a, lambda t: regexp_matches(t, '^[A-Z][a-z]+($|[^\\p{L}\\p{N}_])'))) > len(list_filter(a, lambda t: regexp_matches(t, '^[a-z]+($|[^\\p{L}\\p{N}_])'))) AS up FROM t)
SELECT conv_id, md5(array_to_string(list_transform(a, lambda t: CASE WHEN up AND regexp_matches(t, '^[a-z]+($|[^\\p{L}\\p{N}_])') THEN upper(t[1]) || substr(t, 2) WHEN NOT up AND regexp_matches(t, '^[A-Z][a-z]+($|[^\\p{L}\\p{N}_])') THEN lower(t[1]) || substr(t, 2) ELSE t END), chr(10))) AS texts FROM n""")
def one_case(spark, sf_dir):
    """The turns of a conversation with one case of their first letters, that of most."""
    d = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("a"))
    return d.select("conv_id", F.md5(F.array_join(labels.one_case(F.transform("a", lambda r: r["text"])), "\n")).alias("texts"))


@query("""WITH a AS (SELECT o_orderkey, sha256(concat_ws('|', o_orderkey, o_orderstatus, o_orderpriority)) AS d FROM orders), b AS (SELECT o_orderkey, sha256(concat_ws('|', o_orderkey, CASE WHEN o_custkey % 10 = 0 THEN 'X' ELSE o_orderstatus END, o_orderpriority)) AS d FROM orders)
SELECT b.o_orderkey, b.d AS digest FROM b ANTI JOIN a ON a.d = b.d""")
def stamped_changes(spark, sf_dir):
    """Rows that have changed since a snapshot, by their digests."""
    o = table(spark, sf_dir, "orders")
    digest = lambda status: F.sha2(F.concat_ws("|", F.col("o_orderkey").cast("string"), status, "o_orderpriority"), 256)
    now = o.select("o_orderkey", digest(F.when(F.col("o_custkey") % 10 == 0, "X").otherwise(F.col("o_orderstatus"))).alias("digest"))
    return now.join(o.select(digest(F.col("o_orderstatus")).alias("digest")), "digest", "left_anti").select("o_orderkey", "digest")


@query("""WITH f AS (SELECT event_id, event_type, 'OBJECT<' || array_to_string(list_transform(list_sort(json_keys(props)), lambda k: k || ': ' || CASE json_type(props, '$.' || k) WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'VARCHAR' THEN 'STRING' ELSE json_type(props, '$.' || k) END), ', ') || '>' AS descriptor FROM events)
SELECT sha256(descriptor) AS descriptor, count(*) AS n, min(event_id) AS first, count(DISTINCT event_type) AS kinds FROM f GROUP BY 1""")
def field_inventory(spark, sf_dir):
    """Fields of nested records, grouped by a digest of their names and types."""
    d = table(spark, sf_dir, "events").withColumn("descriptor", F.sha2(F.schema_of_variant(F.parse_json("props")), 256))
    return d.groupBy("descriptor").agg(F.count("*").alias("n"), F.min("event_id").alias("first"), F.countDistinct("event_type").alias("kinds"))


@query("""WITH r AS (SELECT event_id, regexp_extract_all('Rows: ' || props || ' and {bad, then ' || props || '} end', '\\{[^{}]*\\}') AS rows FROM events)
SELECT event_id, len(list_filter(rows, lambda x: json_valid(x))) AS rows, CAST(json_extract(list_filter(rows, lambda x: json_valid(x))[1], '$.k') AS BIGINT) AS first FROM r""")
def noisy_rows(spark, sf_dir):
    """JSON rows out of a noisy reply; a row that doesn't parse loses itself only."""
    reply = F.concat(F.lit("Rows: "), "props", F.lit(" and {bad, then "), "props", F.lit("} end"))
    found = F.transform(F.regexp_extract_all(reply, F.lit("\\{[^{}]*\\}"), F.lit(0)), lambda x: F.get_json_object(x, "$.k").cast("long"))
    good = F.filter(found, lambda x: x.isNotNull())
    return table(spark, sf_dir, "events").select("event_id", F.size(good).cast("long").alias("rows"), F.get(good, F.lit(0)).alias("first"))


@query("""SELECT doc_id, md5(array_to_string(list_filter(string_split(text, '. '), lambda s: NOT regexp_matches(lower(s), '(^|[^a-z])(is|der|que)([^a-z]|$)')), '. ')) AS kept FROM documents""")
def without_noted_sentences(spark, sf_dir):
    """Texts without the sentences that name certain words."""
    keep = F.filter(F.split("text", "\\. "), lambda s: ~F.lower(s).rlike("(^|[^a-z])(is|der|que)([^a-z]|$)"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(F.array_join(keep, ". ")).alias("kept"))


@query("""SELECT page_id, array_to_string(list_filter(string_split_regex(lower(url), '[/. ]+'), lambda s: s <> ''), ' ') AS segments, upper(substr(replace(replace(url, '_', ' '), '-', ' '), 1, 1)) || substr(replace(replace(url, '_', ' '), '-', ' '), 2) AS words,
  regexp_matches(lower(url), '(^|[^a-z])(page|post|item)(s)?([^a-z]|$)') AS named, coalesce(CAST(nullif(regexp_extract(url, '([0-9]+)$', 1), '') AS BIGINT), -1) AS ending FROM pages""")
def name_words(spark, sf_dir):
    """Segments, words and whole-word tests of addresses."""
    u = F.col("url")
    spaced = F.replace(F.replace(u, F.lit("_"), F.lit(" ")), F.lit("-"), F.lit(" "))
    return table(spark, sf_dir, "pages").select(
        "page_id", F.array_join(F.filter(F.split(F.lower(u), "[/. ]+"), lambda s: s != ""), " ").alias("segments"), F.concat(F.upper(F.substring(spaced, 1, 1)), F.substring(spaced, F.lit(2), F.length(spaced))).alias("words"),
        F.lower(u).rlike("(^|[^a-z])(page|post|item)(s)?([^a-z]|$)").alias("named"), F.coalesce(tx.trailing_number(u), F.lit(-1).cast("long")).alias("ending"),
    )


@query("""SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderstatus = 'P' THEN 'outcome' END, CASE WHEN n IS NULL THEN 'steps' END, CASE WHEN o_totalprice < 50000 THEN 'scene' END, CASE WHEN n < 3 THEN 'parts' END) AS gaps FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""")
def annotation_gaps(spark, sf_dir):
    """What a record lacks of what was asked."""
    n = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    d = table(spark, sf_dir, "orders").join(n, "o_orderkey", "left")
    gaps = labels.named({"outcome": F.col("o_orderstatus") == "P", "steps": F.col("n").isNull(), "scene": F.col("o_totalprice") < 50000, "parts": F.col("n") < 3})
    return d.select("o_orderkey", F.array_join(gaps, ",").alias("gaps"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_shipdate < o_orderdate THEN 'before' ELSE 'after' END AS side FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate OR l_shipdate > o_orderdate + INTERVAL 90 DAY""")
def steps_outside(spark, sf_dir):
    """Steps whose times don't fit their episode."""
    l, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    d = l.join(o, l.l_orderkey == o.o_orderkey).where((F.col("l_shipdate") < F.col("o_orderdate")) | (F.col("l_shipdate") > F.col("o_orderdate") + F.expr("INTERVAL 90 DAY")))
    return d.select("l_orderkey", "l_linenumber", F.when(F.col("l_shipdate") < F.col("o_orderdate"), "before").otherwise("after").alias("side"))


#: What breaks each invariant, in SQL that both engines read.
INVARIANTS = {
    "a line number is positive": "l_linenumber < 1",
    "a discount is a share": "NOT l_discount BETWEEN 0 AND 0.05",
    "content is there": "l_returnflag IS NULL OR l_linestatus = ''",
    "a price is that of its quantity": "l_extendedprice < l_quantity",
}


@query("WITH c AS (SELECT " + ", ".join(f"count(*) FILTER ({s}) AS c{k}" for k, s in enumerate(INVARIANTS.values())) + ", (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linenumber) < count(*))) AS d FROM lineitem) SELECT unnest([" + ", ".join(f"'{n}'" for n in INVARIANTS) + ", 'starts are distinct']) AS invariant, unnest([" + ", ".join(f"c{k}" for k in range(len(INVARIANTS))) + ", d]) AS broken FROM c")
def export_invariants(spark, sf_dir):
    """How many rows (or keys) of a written table break each invariant."""
    l = table(spark, sf_dir, "lineitem")
    counts = l.agg(*(F.count_if(F.expr(s)).alias(f"c{k}") for k, s in enumerate(INVARIANTS.values())))
    rows = counts.select(F.explode(F.array(*(F.struct(F.lit(n).alias("invariant"), F.col(f"c{k}").alias("broken")) for k, n in enumerate(INVARIANTS)))).alias("r")).select("r.*")
    twice = l.groupBy("l_orderkey").agg((F.countDistinct("l_linenumber") < F.count("*")).alias("bad")).agg(F.count_if("bad").alias("broken"))
    return rows.unionByName(twice.select(F.lit("starts are distinct").alias("invariant"), "broken"))


@query("""WITH m AS (SELECT user_id, event_id, CAST(epoch_us(ts) // 1000 AS BIGINT) AS ms, CAST(epoch_us(ts) // 1000 AS BIGINT) - lag(CAST(epoch_us(ts) // 1000 AS BIGINT)) OVER (PARTITION BY user_id ORDER BY event_id) AS gap FROM events),
c AS (SELECT user_id, gap // 60000 AS gap, count(*) AS n FROM m WHERE gap IS NOT NULL GROUP BY 1, 2), g AS (SELECT user_id, arg_min(gap, (-n, gap)) AS modal FROM c GROUP BY 1)
SELECT event_id, gap // 60000 - modal AS residual FROM m JOIN g USING (user_id)""")
def coded_times(spark, sf_dir):
    """Times as what their gaps (in minutes) differ from the commonest gap of their user."""
    ms = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000)
    d = table(spark, sf_dir, "events").select("user_id", "event_id", ms.alias("ms"))
    d = d.withColumn("gap", F.floor((F.col("ms") - F.lag("ms").over(Window.partitionBy("user_id").orderBy("event_id"))) / 60000))
    n = d.where("gap is not null").groupBy("user_id", "gap").agg(F.count("*").alias("n"))
    modal = n.groupBy("user_id").agg(F.min(F.struct((-F.col("n")).alias("n"), "gap")).alias("m")).select("user_id", F.col("m.gap").alias("modal"))
    return d.join(modal, "user_id").select("event_id", (F.col("gap") - F.col("modal")).alias("residual"))


@query("""WITH n AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1), m AS (SELECT max(n) AS m FROM n), k AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
p AS (SELECT user_id, unnest(range(1, m + 1)) AS k FROM n, m) SELECT p.user_id, CAST(p.k AS INTEGER) AS k, value FROM p LEFT JOIN k ON p.user_id = k.user_id AND p.k = k.k""")
def padded_rows(spark, sf_dir):
    """Every user's readings padded with nulls to the longest."""
    e = table(spark, sf_dir, "events").withColumn("k", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))).select("user_id", "k", "value")
    most = e.agg(F.max("k")).first()[0] or 0
    every = e.select("user_id").distinct().withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(max(1, most)))))
    return every.join(e, ["user_id", "k"], "left")


DISPOSITIONS = [("view", "note"), ("click", "flag"), ("purchase", "not assessed")]


@query("WITH d(event_type, disposition) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in DISPOSITIONS) + """)
SELECT user_id, count(*) FILTER (disposition = 'flag') AS flags, count(*) FILTER (disposition = 'note') AS notes, count(*) FILTER (disposition = 'not assessed') AS unassessed, count(*) FILTER (disposition IS NULL) AS listed, count(*) FILTER (disposition = 'flag') * 2 < count(*) AND count(*) > 1 AS withheld FROM events LEFT JOIN d USING (event_type) GROUP BY 1""")
def dispositions(spark, sf_dir):
    """Results told apart by a small table of what each kind leads to."""
    d = spark.createDataFrame(DISPOSITIONS, "event_type string, disposition string")
    met = table(spark, sf_dir, "events").join(F.broadcast(d), "event_type", "left")
    n = lambda v: F.count_if(F.col("disposition") == v)
    return met.groupBy("user_id").agg(n("flag").alias("flags"), n("note").alias("notes"), n("not assessed").alias("unassessed"), F.count_if(F.col("disposition").isNull()).alias("listed"), ((n("flag") * 2 < F.count("*")) & (F.count("*") > 1)).alias("withheld"))


@query("""WITH t AS (SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 'success' WHEN 'R' THEN 'partial' ELSE 'unclear' END AS outcome, CASE WHEN l_quantity > 40 THEN 3 WHEN l_quantity > 20 THEN 2 WHEN l_quantity > 5 THEN 1 ELSE 0 END AS rank FROM lineitem),
g AS (SELECT l_orderkey, count(*) AS tasks, max(outcome) AS one, max(rank) AS rank, bool_and(outcome = 'success') AS all_done, bool_or(outcome = 'partial') AS missed FROM t GROUP BY 1)
SELECT l_orderkey, CASE WHEN tasks = 1 THEN CASE one WHEN 'partial' THEN 'failure' ELSE one END END AS verdict, CASE WHEN tasks = 1 THEN 0 ELSE tasks END AS shown, [NULL, 'low', 'medium', 'high'][rank + 1] AS severity,
  CASE WHEN tasks = 1 THEN 'verdict' WHEN all_done THEN 'complete' WHEN missed THEN 'incomplete' ELSE 'open' END AS completion FROM g""")
def verdicts(spark, sf_dir):
    """The verdict of a record with one task, else its tasks; the highest severity; what is complete."""
    outcome = F.when(F.col("l_returnflag") == "A", "success").when(F.col("l_returnflag") == "R", "partial").otherwise("unclear")
    q = F.col("l_quantity")
    rank = F.when(q > 40, 3).when(q > 20, 2).when(q > 5, 1).otherwise(0)
    g = table(spark, sf_dir, "lineitem").select("l_orderkey", outcome.alias("outcome"), rank.alias("rank")).groupBy("l_orderkey").agg(
        F.count("*").alias("tasks"), F.max("outcome").alias("one"), F.max("rank").alias("rank"), F.bool_and(F.col("outcome") == "success").alias("done"), F.bool_or(F.col("outcome") == "partial").alias("missed"))
    one = F.col("tasks") == 1
    verdict = F.when(one, F.when(F.col("one") == "partial", "failure").otherwise(F.col("one")))
    completion = F.when(one, "verdict").when(F.col("done"), "complete").when(F.col("missed"), "incomplete").otherwise("open")
    severity = F.when(F.col("rank") == 3, "high").when(F.col("rank") == 2, "medium").when(F.col("rank") == 1, "low")
    return g.select("l_orderkey", verdict.alias("verdict"), F.when(one, 0).otherwise(F.col("tasks")).alias("shown"), severity.alias("severity"), completion.alias("completion"))

"""Label records against plain versions and edge rows."""

import random

from pyspark.sql import functions as F

from spanloom.functions import text as tx
from spanloom.operators import labels, records

FIELDS = "outcome string, relation string, matches boolean, goal double, undone double, done double, last_change double, peak double, first_full double, first_goal double, mismatch boolean"


def test_contradictions_of_records_with_missing_fields(spark):
    rows = [
        (("success", "different", True, 5.0, None, 5.2, None, 1.0, 5.0, None, None), []),
        (("success_then_undone", "aligned", False, 5.0, 5.0, None, None, None, None, None, None), ["alignment_vs_match", "undone_timing"]),
        (("success_then_undone", "broader", True, 5.0, 8.0, None, 4.0, None, None, None, None), ["outcome_vs_partial", "nothing_after_goal"]),
        (("failure", None, None, -1.0, None, 99.0, None, 1.0, None, None, None), ["progress_vs_outcome", "time_past_end", "time_before_start"]),
        (("success", "aligned", True, 20.0, None, 10.0, None, 1.0, 40.0, 10.0, None), ["goal_times_differ", "progress_past_goal"]),
        (("success", "aligned", True, 20.0, None, 20.0, None, 1.0, 2.0, None, True), ["progress_before_goal"]),
        ((None,) * 11, []),
    ]
    df = spark.createDataFrame([r for r, _ in rows], FIELDS).withColumn("duration", F.lit(45.0))
    got = df.select(labels.contradictions(**{c: F.col(c) for c in df.columns}).alias("r")).collect()
    want = [w for _, w in rows]
    want[0] = ["outcome_vs_alignment"]
    assert [r.r for r in got] == want


def test_linked_issues_are_those_of_all_pairs(spark):
    pick = random.Random(6)
    rows = [(k, pick.choice("ab"), pick.randrange(3), None if k % 17 == 0 else float(pick.randrange(600)), None if k % 5 == 0 else float(pick.randrange(600)), "wide" if k % 13 == 0 else None) for k in range(150)]
    df = spark.createDataFrame(rows, "i long, key string, part int, s double, e double, why string")
    group = {r[0]: r[0] for r in rows}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in rows:
        for b in rows:
            if a[0] < b[0] and a[1] == b[1]:
                near = a[2] != b[2] and None not in (a[3], b[3]) and max(a[3], b[3]) - min(max(a[3], a[4] or 0), max(b[3], b[4] or 0)) <= 4
                if near or a[5] and b[5]:
                    x, y = sorted((root(a[0]), root(b[0])))
                    group[y] = x
    of = labels.linked_issues(df, ["key"], "i", "part", "s", "e", "why", near=4.0)
    assert {r.i: r.group for r in of.collect()} == {k: root(k) for k in group}
    texts = df.withColumns({"severity": F.lit("low"), "text": F.col("i").cast("string")})
    rows_of = labels.grouped_issues(texts, of, "i", "part", "s", "e", "severity", "text")
    back = rows_of.select(F.explode("texts").alias("i")).select(F.col("i").cast("long"))
    assert labels.same_rows(df.select("i"), back) and not labels.same_rows(df.select("i"), back.limit(10))


def test_order_pages_and_outlines_of_few_rows(spark):
    df = spark.createDataFrame([(1, [(2.0, None), (None, 1.0), (2.0, 1.0), (1.0, 9.0), (None, None)])], "k int, a array<struct<s: double, e: double>>")
    assert [tuple(x) for x in df.select(labels.chronological(F.col("a"), "s", "e").alias("a")).first().a] == [(1.0, 9.0), (2.0, 1.0), (2.0, None), (None, 1.0), (None, None)]
    rows = spark.createDataFrame([(1, 1, 500), (1, 2, 1), (2, 1, 10), (2, 2, 10), (2, 3, 90)], "g int, k int, n int")
    assert sorted((r.g, r.k) for r in labels.page(rows, ["g"], ["k"], "n", 100).collect()) == [(1, 1), (2, 1), (2, 2)]
    line = spark.createDataFrame([(1, k, float(abs(k - 5))) for k in range(10)] + [(2, 0, 1.0)], "g int, k int, v double")
    got = {(r.g, r.k): r.why for r in labels.outline(line, ["g"], "k", ["v"], 6).collect()}
    assert got[1, 0] == got[1, 9] == got[2, 0] == "end" and got[1, 5] == "peak" and got[1, 4] == got[1, 6] == "neighbour" and len(got) == 7
    assert labels.outline(line.limit(0), ["g"], "k", ["v"], 6).count() == 0


def test_replies_are_mended_where_one_bracket_is_wrong(spark):
    replies = ['{"a": [1, 2]}', ' ```json\n{"a": 1}\n``` ', '{"a": [1, 2}}', '{"a": [1, 2]]', '{"a": [1, 2', "", None, "no json } at all", '{"a": "}"]']
    df = spark.createDataFrame([(k, r) for k, r in enumerate(replies)], "k int, r string")
    got = [r.j for r in df.select("k", records.repaired(F.col("r")).alias("j")).orderBy("k").collect()]
    assert got == ['{"a": [1, 2]}', '{"a": 1}', '{"a": [1, 2]}', '{"a": [1, 2]}', None, None, None, None, '{"a": "}"}']
    steps = spark.createDataFrame([([("2", "x", "LEFT"), (None, "1", None), ("1.5s", "0.5", "up"), ("2", "0.1", None)],)], "s array<struct<t: string, p: string, arm: string>>")
    line = steps.select(records.timeline(F.col("s"), ["left"], tx.number).alias("x")).first().x
    assert [tuple(s) for s in line] == [(1.5, 2, 0.5, "unclear"), (2.0, 0, None, "left"), (2.0, 3, 0.1, "unclear")]

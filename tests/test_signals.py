"""Signals, parts, maps and published tables against plain versions and edge rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from spanloom.functions import text as tx
from spanloom.operators import parts, sequences, signals
from spanloom.session import new_folder
from spanloom.sources import files
from spanloom.streaming import streams

BAD = [None, float("nan"), float("inf")]


def plain_spans(x, tolerance, need, complete):
    """From left to right, trying every start anew."""
    out, k, n = [], 0, len(x)
    read = lambda v: v is not None and math.isfinite(v)
    while k < n:
        jump = k and read(x[k]) and read(x[k - 1]) and abs(x[k] - x[k - 1]) > tolerance
        if complete and not read(x[k]) or jump:
            k += 1
            continue
        end, seen = k, []
        while end < n and (read(x[end]) or not complete):
            more = seen + ([x[end]] if read(x[end]) else [])
            if more and max(more) - min(more) > tolerance:
                break
            seen, end = more, end + 1
        if end - k >= need:
            out.append((k, end - 1, end - k))
            k = end
        else:
            k += 1
    return out


@pytest.mark.parametrize("complete", [False, True])
def test_calm_spans_are_those_of_a_plain_search(spark, complete):
    pick, rows, want = random.Random(4), [], {}
    for key in range(12):
        x = [pick.choice([0.0, 1.0, 1.0, 2.0, 9.0, *(BAD if key % 2 else [])]) for _ in range(pick.choice([0, 1, 5, 80]))]
        rows += [(key if key else None, k, v) for k, v in enumerate(x)]
        want[key if key else None] = plain_spans(x, 1.0, 3, complete)
    df = spark.createDataFrame(rows, "key int, k int, v double").repartition(5)
    got = {}
    for r in signals.calm_spans(df, ["key"], ["k"], ["v"], [1.0], 3, complete).collect():
        got.setdefault(r.key, []).append((r.first, r.last, r.n))
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}
    assert signals.calm_spans(df.limit(0), ["key"], ["k"], ["v"], [1.0], 3).count() == 0


def test_rest_of_signals_that_hold_an_end(spark):
    series = {
        "low": [0.0] * 50 + [10.0] * 10 + [0.0] * 40,
        "loaded": [0.0] * 2 + [10.0] * 90 + [0.0] * 8,
        "far from zero": [5.0] * 40 + [6.0] * 20 + [5.0] * 40,
        "drift": [k / 10 for k in range(100)],
        "constant": [3.0] * 20,
        "none": [None, float("nan")],
    }
    rows = [(k, j, v) for k, x in series.items() for j, v in enumerate(x)]
    df = spark.createDataFrame(rows, "key string, k int, v double")
    levels = signals.rest(df, ["key"], ["k"], "v")
    got = {r.key: (r.side, r.level) for r in levels.collect()}
    assert got["low"] == (-1, 0.0) and got["loaded"] == (-1, 0.0) and got["far from zero"] == (-1, 5.0)
    assert got["drift"][0] == 0 and got["drift"][1] == pytest.approx(4.95) and got["constant"] == (0, 3.0) and got["none"] == (0, 0.0)
    swings = {r.key: r.swing for r in signals.swing(df, ["key"], "v", levels).collect()}
    assert swings["loaded"] == 10.0 and swings["constant"] == 0.0 and swings["none"] is None
    assert signals.rest(df.limit(0), ["key"], ["k"], "v").count() == 0


def test_peak_lag_is_refined_between_lags(spark):
    t = [math.sin(k / 3) + math.sin(k / 7.3) for k in range(203)]
    df = spark.createDataFrame([(1, k, t[k + 2], 0.6 * t[k] + 0.4 * t[k + 1]) for k in range(200)], "key int, k int, x double, y double")
    r = sequences.lagged_correlation(df, ["key"], ["k"], "x", "y", range(6))
    assert 1.2 < signals.peak_lag(r, ["key"]).first().peak < 2.0
    edge = spark.createDataFrame([(1, 0, 0.9), (1, 1, 0.5), (2, 0, None)], "key int, lag int, r double")
    assert [(x.key, x.peak) for x in signals.peak_lag(edge, ["key"]).collect()] == [(1, 0.0)]


def test_clocks_with_faults_are_placed(spark):
    clocks = {"fine": [0.0, 1.0, 1.0, 3.0], "back": [2.0, 1.0, 4.0], "gap": [1.0, float("nan"), 3.0], "first": [None, 5.0], "tied": [7.0, 7.0], "one": [7.0]}
    df = spark.createDataFrame([(k, j, t) for k, x in clocks.items() for j, t in enumerate(x)], "key string, j int, t double")
    got = {}
    for r in signals.placed_clock(df, ["key"], ["j"], "t", F.lit(10.0)).orderBy("key", "j").collect():
        got.setdefault((r.key, r.problem), []).append(round(r.placed, 3))
    assert got == {("fine", None): clocks["fine"], ("back", "backwards"): [2.0, 2.1, 2.2], ("gap", "nonfinite"): [1.0, 1.1, 1.2], ("first", "nonfinite"): [0.0, 0.1], ("tied", "tied"): [7.0, 7.1], ("one", None): [7.0]}


@pytest.mark.parametrize("sizes, budget, want", [([5, 1, 9, 9], 12, [4, 1, 4, 3]), ([1, 2], 9, [1, 2]), ([8, 8, 8], 10, [4, 3, 3]), ([0, 5], 3, [0, 3])])
def test_fair_shares(spark, sizes, budget, want):
    df = spark.createDataFrame([(1, k, s) for k, s in enumerate(sizes)], "key int, k int, size long")
    assert [r.share for r in signals.fair_shares(df, ["key"], ["k"], "size", budget).orderBy("k").collect()] == want


def plain_root(edges, x):
    seen = set()
    while x in edges and x not in seen and edges[x] != x:
        seen.add(x)
        x = edges[x]
    return x


def test_roots_of_chains_circles_and_tails(spark):
    pick = random.Random(2)
    edges = {k: pick.randrange(60) for k in range(50)} | {100: 101, 101: 102, 102: 100, 103: 101, 200: 200} | {300 + k: 301 + k for k in range(40)}
    df = spark.createDataFrame([*edges.items()], "node long, to long")
    got = {r.node: r.root for r in parts.roots(df).collect()}
    assert got == {k: plain_root(edges, k) for k, v in edges.items() if k != v}
    assert parts.roots(df.limit(0)).count() == 0


def test_goals_of_parts(spark):
    rows = [(1, 0, "Aligned", True, "success", 5), (1, 1, "narrower ", None, "success", 9), (2, 0, "different", False, "success", 1), (2, 1, "aligned", True, "failure", 2), (3, 0, None, None, None, 1), (4, 0, "broader", False, "partial", None), (5, 0, "unrelated", False, "failure", 1), (5, 1, "different", False, "success", 8), (5, 2, "aligned", True, "success", None)]
    df = spark.createDataFrame(rows, "id int, part int, relation string, matches boolean, outcome string, done int").withColumn("n", F.expr("count(*) over (partition by id)"))
    got = {r.id: (r.relation, r.matches) for r in parts.goal_alignment(df, "id", "relation", "matches", "n").collect()}
    assert got == {1: ("narrower", True), 2: ("different", False), 3: (None, None), 4: (None, None), 5: ("unrelated", False)}
    got = {r.id: (r.outcome, r.done_at) for r in parts.goal_outcome(df, "id", "part", "outcome", "done").collect()}
    assert got == {1: ("success", 5), 2: ("unclear", None), 3: ("unclear", None), 4: ("partial", None), 5: ("success", 8)}


def test_what_is_denied_is_not_asserted(spark):
    texts = ["The cup slipped.", "It did not slip, but the cup slipped", "never slipped; no cup", "slipped and not dropped", "If it slipped", "", None, "Without a sound.\nSlipped"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.a for r in df.select(tx.asserted(F.col("t"), " slipped ").alias("a")).collect()] == [True, True, False, True, False, False, None, True]


def test_upserts_go_on_where_the_last_call_ended(spark, tmp_path):
    source, path = str(tmp_path / "in"), new_folder(spark, "test-upsert")
    schema = "k long, v long, x string"
    for rows in ([(1, 1, "a"), (2, 1, "b")], [(1, 3, "c"), (3, 1, "d")], [(1, 2, "late")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        streams.upsert(streams.from_files(spark, source, spark.read.parquet(source).schema), path, "k", "v")
    assert {(r.k, r.v, r.x) for r in files.published(spark, path).collect()} == {(1, 3, "c"), (2, 1, "b"), (3, 1, "d")}
    assert files.generation(path)[0] == 2 and files.published(spark, path + "-none") is None

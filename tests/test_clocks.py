"""Streams on an anchor's frames, crossed streams, labels on frames, verified groups."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.operators import clocks, exports


def test_changes_on_the_anchor_s_steps(spark):
    draw = np.random.default_rng(1)
    anchor, own, want = [], [], {}
    for key in range(6):
        n, frames = int(draw.integers(2, 30)), int(draw.integers(1, 25))
        values = [None if draw.random() < 0.1 else float(draw.integers(0, 9)) for _ in range(n - 1)]
        shown = sorted(int(x) for x in draw.integers(-1, n + 2, frames))
        anchor += [(key, f, s) for f, s in enumerate(shown)]
        own += [(key, j, v) for j, v in enumerate(values)]
        for f, (a, b) in enumerate(zip(shown, shown[1:])):
            a, b = min(max(a, 0), n - 1), min(max(b, 0), n - 1)
            some = values[a:b]
            want[key, f] = None if b <= a or None in some else sum(some)
    got = clocks.onto_anchor(spark.createDataFrame(anchor, "key int, frame int, shown int"), spark.createDataFrame(own, "key int, j int, v double"), ["key"], "frame", "shown", "j", "v")
    assert {(r.key, r.frame): r.change for r in got.collect()} == want


def test_steps_that_hold_an_anchor_s_step(spark):
    draw = np.random.default_rng(2)
    anchor, own, want = [], [], {}
    for key in range(8):
        ta = np.sort(np.round(draw.uniform(0, 10, 12), 2)).tolist()
        tc = np.sort(np.round(draw.uniform(1, 9, int(draw.integers(2, 30))), 2)).tolist()
        tc = sorted({*tc, *(ta[:2] if key % 2 else [])})
        anchor += [(key, f, t) for f, t in enumerate(ta)]
        own += [(key, j, t) for j, t in enumerate(tc)]
        n = len(tc)
        for i in range(len(ta) - 1):
            a, b = int(np.searchsorted(tc, ta[i], "right")) - 1, int(np.searchsorted(tc, ta[i + 1], "left"))
            first = min(max(a, 0), n - 2)
            want[key, i] = (first, max(first, min(max(b - 1, 0), n - 2)))
    got = clocks.holding_steps(spark.createDataFrame(anchor, "key int, frame int, t double"), spark.createDataFrame(own, "key int, j int, t double"), ["key"], "frame", "t", "j")
    assert {(r.key, r.frame): (r.first, r.last) for r in got.collect()} == want


def test_crossed_streams(spark):
    draw = np.random.default_rng(3)
    rows, cols = [], {}
    for key, swap in (("fine", False), ("crossed", True)):
        a, b = draw.normal(0, 1, 60), draw.normal(0, 1, 60)
        left, right = (b, a) if swap else (a, b)
        cols[key] = [left + draw.normal(0, 0.1, 60), right + draw.normal(0, 0.1, 60), a, b]
        rows += [(key, k, *(float(c[k]) for c in cols[key])) for k in range(60)]
    rows += [("few", k, 1.0 * k, 2.0, None if k > 5 else 1.0 * k, 3.0) for k in range(40)] + [("flat", k, 1.0, float(k % 7), float(k), float(-k)) for k in range(40)]
    df = spark.createDataFrame(rows, "key string, k int, ml double, mr double, vl double, vr double")
    got = {r.key: r for r in clocks.crossed(df, ["key"], ("ml", "mr"), ("vl", "vr")).collect()}
    assert got["fine"].crossed is False and got["crossed"].crossed is True
    assert got["crossed"].left_right == pytest.approx(np.corrcoef(cols["crossed"][0], cols["crossed"][3])[0, 1])
    assert (got["few"].not_assessed, got["few"].crossed, got["few"].right_right) == ("vl", None, None)
    assert got["flat"].left_left is None and got["flat"].crossed is None and got["flat"].right_left is not None
    moved = spark.createDataFrame([("a", 0, 0.0, 0.0, 0.0), ("a", 1, 1.0, 3.0, 4.0), ("a", 2, 2.0, 3.0, 4.0), ("a", 3, 6.0, 3.0, 24.0), ("a", 4, 7.0, None, 1.0)], "key string, k int, t double, x double, y double")
    assert [r.speed for r in clocks.speeds(moved, ["key"], "k", "t", ["x", "y"]).orderBy("k").collect()] == [5.0, 0.0, 5.0, None]


def test_labels_on_frames(spark):
    frames = spark.createDataFrame([("a", t) for t in (0.0, 0.1, 0.2, 0.9, 1.0)], "key string, ts double")
    items = [("a", 0.04, "reach", ["x"]), ("a", 0.15, "grasp", ["y"]), ("a", 0.14, "lift", ["y"]), ("a", 0.5, "hold", ["z"]), ("a", 0.96, "hold", ["z"]), ("a", 1.05, "place", ["w"]), ("a", 1.3, "late", []), ("a", -0.2, "early", []), ("a", None, "untimed", []), ("b", 0.0, "nowhere", [])]
    d = exports.snapped(spark.createDataFrame(items, "key string, t double, text string, names array<string>"), frames, ["key"], "t", "ts", 0.1).cache()
    got = {(r.text, r.t): (r.fate, r.at) for r in d.collect()}
    assert got == {("reach", 0.04): ("placed", 0.0), ("grasp", 0.15): ("placed", 0.1), ("lift", 0.14): ("placed", 0.1), ("hold", 0.5): ("far", 0.2), ("hold", 0.96): ("placed", 1.0), ("place", 1.05): ("placed", 1.0), ("late", 1.3): ("refused", None), ("early", -0.2): ("refused", None), ("untimed", None): ("untimed", None), ("nowhere", 0.0): ("refused", None)}
    rows = exports.persistent_rows(d, frames, ["key"], "t", "text", "ts")
    assert [(r.at, r.text) for r in rows.orderBy("at").collect()] == [(0.0, "reach"), (0.1, "grasp"), (0.2, "hold"), (1.0, "place")]
    assert exports.lost_texts(d, ["key"], "t", "text", "names").count() == 0
    lost = exports.lost_texts(d.withColumn("names", F.when(F.col("text") == "lift", F.array(F.lit("only"))).otherwise(F.col("names"))), ["key"], "t", "text", "names").collect()
    assert [(r.text, r.replaced_by) for r in lost] == [("lift", "grasp")]


def test_rules_of_a_written_set(spark):
    frames = spark.createDataFrame([("a", 0.0), ("a", 1.0), ("b", 0.0)], "key string, ts double")
    persistent = spark.createDataFrame([("a", 0.0, "subtask", "x", None), ("a", 1.0, "note", "y", None), ("b", 0.5, "subtask", "z", "cam"), ("b", 0.5, "subtask", "z2", None), ("c", 0.0, "subtask", "q", None)], "key string, at double, style string, content string, camera string")
    events = spark.createDataFrame([("a", 0.0, "vqa", "e", None, None), ("a", 1.0, "vqa", "e", None, "cam"), ("a", 2.0, "slip", "f", None, None), ("a", 0.0, "slip", None, None, None), ("a", 0.0, "x", "g", None, None)], "key string, at double, style string, content string, calls string, camera string")
    got = {r.rule: r.broken for r in exports.broken(frames, persistent, events, ["key"], "ts", {"persistent": ["subtask"], "events": ["vqa", "slip"], "views": ["vqa"]}).collect()}
    assert got == {"a persistent style in its place": 1, "an event style in its place": 1, "a camera where the view decides": 2, "content or calls": 1, "an event on one frame": 1, "an event on a frame": 1, "a first row on the first frame": 1, "starts are distinct": 1, "starts are frames": 3, "frames for every key": 1}


def test_groups_that_fail_stay_apart(spark):
    issues = spark.createDataFrame([(1, "slip", "low", 5.0, 6.0), (2, "slip", "high", 1.0, None), (3, "slip", None, None, None), (4, "drop", "low", 2.0, 3.0), (5, "drop", "low", 9.0, 4.0), (6, "drop", "low", 1.0, 1.0), (7, "slip", "low", 0.0, 1.0)], "id long, category string, severity string, s double, e double")
    proposed = [("g1", 1, "It slips."), ("g1", 2, "It slips."), ("g1", 3, "It slips."), ("g2", 4, "mixed"), ("g2", 7, "mixed"), ("g3", 5, "alone"), ("g4", 6, "unknown"), ("g4", 99, "unknown"), ("g5", 6, "  ")]
    kept, left = exports.verified_groups(issues, spark.createDataFrame(proposed, "group string, id long, sentence string"), "id", "category", "severity", "s", "e")
    got = {tuple(r.idents): (r.group, r.category, r.severity, r.start, r.end) for r in kept.collect()}
    assert got == {(1, 2, 3): ("g1", "slip", "high", 1.0, 6.0), (4,): (None, "drop", "low", 2.0, 3.0), (5,): (None, "drop", "low", 9.0, 4.0), (6,): (None, "drop", "low", 1.0, 1.0), (7,): (None, "slip", "low", 0.0, 1.0)}
    assert {r.group: r.why for r in left.collect()} == {"g2": "members of several categories", "g3": "fewer than two members", "g4": "an issue is named more than once", "g5": "an issue is named more than once"}

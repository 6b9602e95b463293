"""Rules on few rows with results worked out by hand, and the work of dense inputs."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.operators import labels, records, signals
from spanloom.session import new_folder
from spanloom.streaming import streams


def test_change_threshold_counts_steps_of_zero(spark):
    """Six 0 and four 5: range 5, one step of 5 among nine, so the median step is 0 and a tenth of the range decides."""
    rows = [("a", 0, k, 0.0 if k < 6 else 5.0) for k in range(10)] + [("b", 0, k, 3.0) for k in range(4)] + [("c", 0, k, float(k % 2)) for k in range(9)] + [("d", 0, 0, None), ("d", 0, 1, 1.0)]
    df = spark.createDataFrame(rows, "key string, i int, k int, v double")
    got = {r.key: r.threshold for r in signals.change_threshold(df, ["key"], "i", ["k"], "v").collect()}
    assert got == {"a": 0.5, "b": 0.0, "c": 1.0, "d": 0.0}


def test_supported_rate_keeps_what_is_not_stated(spark):
    rows = [(None, 30.0), (0.0, 30.0), (-1.0, 30.0), (float("nan"), 30.0), (30.0, None), (30.0, 3.0), (30.0, 2.999), (2.0, 29.97004), (976562.5, 30.0)]
    df = spark.createDataFrame(rows, "stated double, own double")
    got = [r[0] for r in df.select(signals.supported_rate(F.col("stated"), F.col("own"))).collect()]
    assert got[:3] == [None, 0.0, -1.0] and np.isnan(got[3]) and got[4:] == [30.0, 30.0, 2.999, 29.97, 30.0]


def test_one_case(spark):
    texts = [["turn", "go", "UMI moves"], ["UMI moves", "pause"], ["Turn", "go"], ["Turn", "Go", "pull back"], ["X3 on", "A box", "Turn it"], ["Élan", "Turn", "Go", "caféine up"], [], [None, "Go"]]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t array<string>")
    got = [r[0] for r in df.select("k", labels.one_case(F.col("t")).alias("t")).orderBy("k").select("t").collect()]
    assert got == [["turn", "go", "UMI moves"], ["UMI moves", "pause"], ["turn", "go"], ["Turn", "Go", "Pull back"], ["X3 on", "A box", "Turn it"], ["Élan", "Turn", "Go", "caféine up"], [], [None, "Go"]]


def test_lasting_words(spark):
    said = {"blocked all along": "wording", "dark for the rest of it": "wording", "the whole take is dark": "wording", "the whole thing": None, "it slips": None, "It PERSISTS": "wording"}
    df = spark.createDataFrame([(t,) for t in said], "t string")
    got = {r.t: r.w for r in df.select("t", labels.condition(F.lit(1.0), F.lit(2.0), F.lit(100.0), F.col("t")).alias("w")).collect()}
    assert got == said


def test_localized_needs_a_rest_and_few_active_values(spark):
    """Ten values a frame.  a: one presses now and then; b: all press together; c: never rests."""
    rows = []
    for k in range(50):
        for i in range(10):
            rows += [("a", k, i, 10.0 if k % 5 == 0 and i == 3 else 0.0), ("b", k, i, 10.0 if k % 5 == 0 else 0.0), ("c", k, i, float((k * 7 + i * 13) % 101))]
    df = spark.createDataFrame(rows, "key string, k int, i int, v double")
    levels = signals.rest(df, ["key"], ["k", "i"], "v")
    swings = signals.swing(df, ["key"], "v", levels)
    swings = swings.withColumn("swing", F.when(F.col("key") == "a", 10.0).otherwise(F.col("swing")))
    rests = signals.behaviour(df, ["key"], "v", levels, swings)
    got = {r.key: r.localized for r in signals.localized(df, ["key"], "k", "v", levels, swings, rests).collect()}
    assert got == {"a": True, "b": False, "c": False}


@pytest.mark.parametrize("parts", [1, 2, 50])
def test_near_issues_are_tied_about_once_each(parts):
    """n issues within the limit of each other: as many ties as issues, however many pairs are near."""
    n = 20_000
    t = np.sort(np.random.default_rng(1).uniform(0, 15, n))
    kernel = labels.Meeting(15.0)
    began = time.perf_counter()
    got = [kernel.add(np.arange(k, k + 1000), np.arange(k, k + 1000) % parts, t[k : k + 1000], t[k : k + 1000]) for k in range(0, n, 1000)]
    ties = sum(len(g[0]) for g in got if g)
    assert ties <= n and (ties >= n - 1 - parts if parts > 1 else ties == 0) and time.perf_counter() - began < 5


def test_a_long_reply_is_mended_in_one_pass(spark):
    step = '{"t": 1, "note": "a } in a string, and \\" a quote", "at": [1, 2, [3]]}'
    whole = '{"steps": [' + ", ".join([step] * 3000) + "]}"
    wrong = whole[:100_000] + whole[100_000:].replace("[3]]}", "[3}]}", 1)
    twice = wrong.replace("[3]]}", "[3)]}", 1)
    rows = [(0, wrong), (1, twice), (2, whole[:-1]), (3, whole), (4, '{"a": (1)}'), (5, '{"a": [1)}'), (6, '{"a": "open}'), (7, "]" + whole)]
    df = spark.createDataFrame(rows, "k int, r string")
    assert len(whole) > 200_000
    df.where("k = 0").select(records.repaired(F.col("r"))).collect()
    began = time.perf_counter()
    got = [r[0] for r in df.select("k", records.repaired(F.col("r")).alias("j")).orderBy("k").select("j").collect()]
    assert time.perf_counter() - began < 20
    assert got == [whole, None, None, whole, None, '{"a": [1]}', None, None]


def test_running_totals_over_several_files(spark):
    """Each file has users of its own and one that all have; a batch changes only its own."""
    path = new_folder(spark, "events")
    rows = [(f, u, float(k)) for f in range(4) for u in (10 * f, 10 * f + 1, 999) for k in range(5)]
    for f in range(4):
        spark.createDataFrame([(u, v) for g, u, v in rows if g == f], "user_id long, value double").coalesce(1).write.mode("append").parquet(path)
    stream = streams.from_files(spark, path, spark.read.parquet(path).schema)
    got = {r.user_id: (r.n, r.total) for r in streams.run_to_end(streams.running_totals(stream), "update", ["user_id"]).collect()}
    assert got == {u: (20, 40.0) if u == 999 else (5, 10.0) for _, u, _ in rows}
    with pytest.raises(ValueError):
        streams.run_to_end(stream, "update")


def test_places_and_sums_over_ranges(spark):
    from spanloom.operators import places

    draw = np.random.default_rng(3)
    rows = [(k, int(draw.integers(0, 50)), None if k % 11 == 0 else float(draw.integers(0, 9))) for k in range(3000)]
    df = spark.createDataFrame(rows, "k int, g int, v double").repartition(7)
    got = {r.k: (r.place, r.so_far) for r in places.placed(df, [F.desc("g"), F.col("k")], {"so_far": "v"}).collect()}
    want, total = {}, 0.0
    for place, (k, _, v) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0]))):
        total += v or 0
        want[k] = (place, total)
    assert got == want and places.placed(df.limit(0), ["k"]).count() == 0
    n = spark.range(23).withColumn("n", F.lit(23))
    assert [r[0] for r in n.select(places.tile(F.col("id"), F.col("n"), 10)).collect()] == [t for t, c in enumerate([3, 3, 3, *[2] * 7], 1) for _ in range(c)]
    chunks = places.in_chunks(spark.range(10).withColumnRenamed("id", "place"), 4, 1).collect()
    assert sorted((r.chunk, r.place) for r in chunks if not r.inner) == [(0, 4), (1, 3), (1, 8), (2, 7)] and sum(r.inner for r in chunks) == 10


def test_the_second_writer_of_a_generation_fails(spark, monkeypatch):
    from spanloom.sources import files

    path = new_folder(spark, "published")
    files.publish(spark.range(3), path)
    before = files.generation(path)
    files.publish(spark.range(5), path)
    monkeypatch.setattr(files, "generation", lambda _: before)
    with pytest.raises(RuntimeError):
        files.publish(spark.range(7), path)
    monkeypatch.undo()
    assert files.published(spark, path).count() == 5
    files.publish(spark.range(9), path)
    assert files.published(spark, path).count() == 9


def test_merges_write_only_the_buckets_of_their_keys(spark):
    from spanloom.sources import files

    path = new_folder(spark, "merged")
    table = lambda rows: spark.createDataFrame(rows, "k long, v int, x string")
    files.merge(table([(k, 1, "a") for k in range(200)]), path, "k", "v", 16)
    first = files.generation(path)[1]
    files.merge(table([(5, 2, "b"), (5, 3, "c"), (7, 0, "old"), (1000, 1, "new")]), path, "k", "v", 16)
    second = files.generation(path)[1]
    assert sum(first[k] != second[k] for k in first) <= 3 and set(first) <= set(second)
    want = {k: (1, "a") for k in range(200)} | {5: (3, "c"), 1000: (1, "new")}
    assert {r.k: (r.v, r.x) for r in files.published(spark, path).collect()} == want
    files.merge(table([]), path, "k", "v", 16)
    assert files.published(spark, path).count() == 201
    files.publish(table([(k, 1, "whole") for k in range(9)]), path)
    files.merge(table([(3, 5, "m")]), path, "k", "v", 16)
    assert {r.k: r.x for r in files.published(spark, path).collect()} == {k: "m" if k == 3 else "whole" for k in range(9)}
    empty = new_folder(spark, "merged")
    files.merge(table([]), empty, "k", "v")
    assert files.published(spark, empty).count() == 0

"""Indexed reads, labels of tables, swapped letters, spread samples."""

import itertools
from collections import deque

from pyspark.sql import functions as F

from spanloom.operators import sampling
from spanloom.session import new_folder
from spanloom.sources import index


def test_reads_open_only_the_files_that_hold_what_is_asked(spark):
    path = new_folder(spark, "frames")
    rows = [(e, f, float(e * f), "x" * 50) for e in range(40) for f in range(25)] + [(None, 3, 1.0, "nobody's")]
    df = spark.createDataFrame(rows, "episode int, frame int, v double, wide string")
    df.repartitionByRange(8, "episode").sortWithinPartitions("episode", "frame").write.parquet(path)
    whole = spark.read.parquet(path)
    ix = index.recording_index(whole, "episode", "frame").cache()
    assert ix.count() == 40 and ix.agg(F.sum("n")).first()[0] == 1000
    assert all(r.n == 25 and r.together and r.problem is None for r in index.recordings(ix, "episode").collect())
    some = index.read_recordings(spark, path, ix, "episode", [3, 4], ["episode", "frame", "v"])
    assert sorted((r.episode, r.frame, r.v) for r in some.collect()) == [(e, f, float(e * f)) for e in (3, 4) for f in range(25)]
    assert len(some.inputFiles()) <= 2 < len(whole.inputFiles())
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "wide" not in plan[plan.index("ReadSchema") :] and "In(episode, [3,4])" in plan
    asked = spark.createDataFrame([(7,), (7,), (99,), (None,)], "episode int")
    for most in (index.MOST_FILES, 0):
        got = index.read_recordings(spark, path, ix, "episode", asked, ["frame"], most)
        assert sorted(r.frame for r in got.collect()) == list(range(25))
    assert index.read_recordings(spark, path, ix, "episode", [], ["v"]).count() == 0
    spark.createDataFrame([(50, 0, 0.0, ""), (50, 2, 0.0, ""), (51, 0, 0.0, ""), (51, 0, 0.0, "")], df.schema).write.mode("append").parquet(path)
    again = index.recordings(index.recording_index(spark.read.parquet(path), "episode", "frame"), "episode")
    assert {r.episode for r in again.where("problem = 'frames'").collect()} == {50, 51}


def test_table_labels(spark):
    rows = [(1, "Pick", None), (1, "Pick", None), (2, "Place", ""), (2, "Put", ""), (3, None, "  "), (4, "a", "b"), (None, "lost", None), (5, None, " Turn ")]
    got = {r.code: (r.label, r.why, r.rows) for r in index.table_labels(spark.createDataFrame(rows, "code int, name string, note string"), "code", ["name", "note"]).collect()}
    assert got == {1: ("Pick", None, 2), 2: (None, "conflicting rows", 2), 3: (None, "no unique text", 1), 4: (None, "no unique text", 1), 5: ("Turn", None, 1)}


def test_swapped_letters_against_every_swap(spark):
    words = ["dropout", "glare", "frozen", "from", "form", "aab", "noise", "ab"]
    texts = ["A dorpout and Galre, FROZNE!", "from form fomr", "dropout glare", None, "", "nothing here", "éclair gl", "rdopout x rdopout nosie-frozne", "forzen" * 3]
    swaps = lambda w: [w[:k] + w[k + 1] + w[k] + w[k + 2 :] for k in range(len(w) - 1) if w[k] != w[k + 1]]

    def plain(text):
        out, n = "", 0
        for letters, group in itertools.groupby(text, str.isalpha):
            p = "".join(group)
            fits = [w for w in swaps(p.lower()) if w in words] if letters and len(p) >= 4 and p.lower() not in words else []
            if fits:
                new = fits[0]
                p, n = new.upper() if p == p.upper() else new.capitalize() if p[0] != p[0].lower() else new, n + 1
            out += p
        return out, n

    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    vocabulary = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r.id: (r.fixed, r.swaps) for r in index.spelled(df, "id", "text", vocabulary, "w").collect()}
    assert got == {k: (None, 0) if t is None else plain(t) for k, t in enumerate(texts)}
    assert got[0][0] == "A dropout and Glare, FROZEN!" and got[1][0] == "from form form"


def breadth_first(n):
    out, todo = [], deque([(0, n - 1)])
    while todo:
        lo, hi = todo.popleft()
        if lo <= hi:
            mid = (lo + hi) // 2
            out.append(mid)
            todo += [(lo, mid - 1), (mid + 1, hi)]
    return out


def test_spread_order_is_middles_first(spark):
    rows = [(n, i) for n in (1, 2, 3, 7, 10, 64, 100) for i in range(n)]
    got = {}
    for r in sampling.spread_turns(spark.createDataFrame(rows, "n int, i int"), "n", ["i"]).orderBy("n", "turn").collect():
        got.setdefault(r.n, []).append(r.i)
    assert got == {n: breadth_first(n) for n in got} and len(got) == 7


def test_samples_to_a_target(spark):
    rows = [(t, i, 1.0 + (i * 7 + len(t)) % 5) for t, n in (("a", 9), ("b", 4), ("c", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "task string, i int, s double")

    def plain(target, cap):
        left = {t: [i for i in breadth_first(n)] for t, n in (("a", 9), ("b", 4), ("c", 1))}
        own, total, out = dict.fromkeys(left, 0.0), 0.0, []
        seconds = {(t, i): s for t, i, s in rows}
        going = True
        while total < target and going:
            going = False
            for t in sorted(left):
                if left[t] and (cap is None or own[t] < cap) and total < target:
                    i = left[t].pop(0)
                    own[t] += seconds[t, i]
                    total += seconds[t, i]
                    out.append((t, i))
                    going = True
        return sorted(out)

    for target, cap in ((0.5, None), (9.0, None), (20.0, None), (1e9, None), (20.0, 4.0), (1e9, 6.0)):
        got = sampling.sampled_to_target(df, "task", ["i"], "s", target, cap)
        assert sorted((r.task, r.i) for r in got.collect()) == plain(target, cap)
    packs = df.withColumn("pack", F.floor(F.col("i") / 3))
    got = sampling.sampled_packs(packs, "task", ["pack"], "s", 12.0).collect()
    assert {(r.task, r.pack) for r in got} >= {("a", 1)} and all(len([x for x in rows if x[0] == t and x[1] // 3 == p]) == sum(r.task == t and r.pack == p for r in got) for t, p in {(r.task, r.pack) for r in got})


def test_swaps_that_put_a_letter_without_a_capital_first(spark):
    df = spark.createDataFrame([(1, "Üßung, üßung"), (2, "ÜẞUNG")], "id long, text string")
    got = {r.id: (r.fixed, r.swaps) for r in index.spelled(df, "id", "text", spark.createDataFrame([("ßüung",)], "w string"), "w").collect()}
    assert got == {1: ("ßüung, ßüung", 2), 2: ("ßÜUNG", 1)}

"""Edge rows: empty tables, nulls, ties, touching and empty intervals, groups that are too small."""

import random

from pyspark.sql import functions as F

from spanloom.operators import asof, components, intervals, parts, sampling, scores, sequences, similarity

SPANS = "k string, s double, e double"


def test_union_of_touching_nested_empty_and_null_intervals(spark):
    rows = [("a", 0.0, 1.0), ("a", 1.0, 2.0), ("a", 0.2, 0.4), ("a", 5.0, 5.0), ("a", None, 9.0), ("b", 3.0, 2.0), (None, 0.0, 1.0)]
    got = {(r.k, r.s, r.e) for r in intervals.merge(spark.createDataFrame(rows, SPANS), ["k"]).collect()}
    assert got == {("a", 0.0, 2.0), (None, 0.0, 1.0)}
    assert intervals.merge(spark.createDataFrame([], SPANS), ["k"]).count() == 0


def test_segments_against_counting_by_hand(spark):
    pick = random.Random(3)
    rows = [("a", float(s), float(s + pick.randint(0, 6))) for s in (pick.randint(0, 20) for _ in range(30))]
    got = intervals.segments(spark.createDataFrame(rows, SPANS), ["k"]).collect()
    for r in got:
        middle = (r.s + r.e) / 2
        assert r.n_open == sum(s < middle < e for _, s, e in rows) > 0
    assert sum(r.e - r.s for r in got) == sum(any(s < t + 0.5 < e for _, s, e in rows) for t in range(40))


def test_difference_by_points(spark):
    pick = random.Random(4)
    make = lambda: [("a", float(s), float(s + pick.randint(1, 5))) for s in (pick.randint(0, 30) for _ in range(8))]
    a, b = make(), make()
    got = intervals.difference(spark.createDataFrame(a, SPANS), spark.createDataFrame(b, SPANS), ["k"]).collect()
    for t in range(40):
        inside = lambda some: any(s < t + 0.5 < e for s, e in some)
        assert inside([(r.s, r.e) for r in got]) == (inside([x[1:] for x in a]) and not inside([x[1:] for x in b]))


def test_asof_takes_the_last_row_at_or_before_and_of_ties_the_smallest(spark):
    left = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 5.0), ("b", 3, 1.0)], "k string, i int, t double")
    right = spark.createDataFrame([("a", 10, 1.0), ("a", 11, 1.0), ("a", 12, 4.0)], "k string, r int, t double")
    got = asof.backward(left, right, ["k"], "t", "r", ["r"]).collect()
    assert {(x.k, x.i, x.m and x.m.r) for x in got} == {("a", 1, 10), ("a", 2, 12), ("b", 3, None)}


def test_sessions_split_only_beyond_the_gap(spark):
    rows = [("a", 0.0), ("a", 10.0), ("a", 20.5), ("b", 0.0)]
    got = sequences.sessions(spark.createDataFrame(rows, "k string, t double"), ["k"], "t", 10.0)
    assert got.select("k", "session").distinct().count() == 3


def test_components_of_a_long_path_a_star_and_loops(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 400)] + [(7, 7)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 1 for k in range(1, 41)} | {k: 100 for k in range(100, 400)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_similar_sets_against_all_pairs_of_different_sets(spark):
    pick = random.Random(5)
    sets = {k: {pick.choice("abcdefgh") for _ in range(4)} for k in range(25)}
    df = spark.createDataFrame([(k, sorted(v)) for k, v in sets.items()], "item long, tokens array<string>")
    got = {tuple(sorted((r.a, r.b))) for r in similarity.set_pairs(df, "item", "tokens", 0.6).collect()}
    # One item, the smallest, stands for all with the same set.
    firsts = {tuple(sorted(v)): k for k, v in sorted(sets.items(), reverse=True)}.values()
    assert got == {(a, b) for a in firsts for b in firsts if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.6}


def test_peers_leave_their_own_value_out(spark):
    rows = [("g", k, float(k)) for k in range(6)] + [("h", 9, 1.0)]
    got = {r.i: r.peer_median for r in scores.leave_one_out_median(spark.createDataFrame(rows, "g string, i int, v double"), ["g"], "v", "i").collect()}
    assert got[0] == 3.0 and got[5] == 2.0 and got[9] is None


def test_top_rows_of_each_group_with_ties(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 5.0), ("a", 3, 1.0)], "k string, i int, v double")
    got = sampling.top_per(df, ["k"], [F.desc("v"), F.col("i")], 2).collect()
    assert [(r.i, r["rank"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1), (2, 2)]


def test_rows_of_one_place_are_spent_together(spark):
    df = spark.createDataFrame([("a", 1, 6.0), ("a", 2, 3.0), ("a", 2, 2.0), ("a", 3, 1.0), ("b", 1, 20.0), ("b", 1, 1.0)], "k string, i int, x double")
    got = sampling.until_cap(df, ["k"], [F.col("i")], "x", 9.0).collect()
    assert sorted(tuple(r) for r in got) == [("a", 1, 6.0, 6.0), ("a", 2, 3.0, 11.0), ("b", 1, 20.0, 21.0)]


def test_maps_are_followed_without_broadcasts(spark, monkeypatch):
    plans, kept = [], parts.stored
    monkeypatch.setattr(parts, "stored", lambda d, name: (plans.append(d._jdf.queryExecution().executedPlan().toString()), kept(d, name))[1])
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (102, 101)], "node long, to long")
    got = {r.node: r.root for r in parts.roots(edges).collect()}
    assert got == {k: 40 for k in range(40)} | {100: 101, 101: 101, 102: 102}
    assert any("Join" in p for p in plans) and not any("Broadcast" in p for p in plans)


def test_pools_hold_prices_and_not_parts(spark, tmp_path, monkeypatch):
    from spanloom.plans import parts as plans

    pick = random.Random(3)
    rows = [(k, f"{pick.choice('abc')} {pick.choice('xyz')}", f"B{k % 2}", float(pick.randint(1, 6))) for k in range(300)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    ranked, kept = [], plans.placed
    monkeypatch.setattr(plans, "placed", lambda d, *more: (ranked.append(d.count()), kept(d, *more))[1])
    got = {r.p_partkey: (r.peers, r.peer_median) for r in plans.similar_pools(spark, str(tmp_path)).collect()}
    others = {k: sorted(p for j, n, c, p in rows if j != k and c == b and set(n.split()) & set(a.split())) for k, a, b, _ in rows}
    assert got == {k: (len(v), (v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2) for k, v in others.items()}
    assert ranked == [2 * 9 * 6]


def test_few_pairs_that_are_not_alike_leave_the_join(spark):
    pick = random.Random(8)
    sets = {k: sorted({f"w{int(pick.paretovariate(0.4)) % 900}" for _ in range(pick.randint(4, 60))}) for k in range(200)}
    sets |= {k + 200: sorted({*v[1:], "new"}) for k, v in sets.items() if k % 10 == 0}
    share = lambda a, b: len({*sets[a]} & {*sets[b]}) / len({*sets[a]} | {*sets[b]})
    want = {(a, b) for a in sets for b in sets if a < b and sets[a] != sets[b] and share(a, b) >= 0.5}
    groups = spark.createDataFrame([(k, v, len(v)) for k, v in sets.items()], "g long, t array<string>, n int")
    met = {(r.a, r.b) for r in similarity.candidates(groups, 0.5).collect()}
    assert want and want <= met and len(met) < 4 * len(want) + 200


def test_points_of_a_key_are_those_of_percentile(spark):
    from spanloom.operators import places

    pick = random.Random(4)
    rows = [(k, None if k == 7 or pick.random() < 0.1 else round(pick.gauss(0, 3), 1 if k % 2 else 9)) for k in [1, 2, 3, 7] for _ in range(97)] + [(9, 1.5), (10, 1.0), (10, 2.0)]
    df = spark.createDataFrame(rows, "k int, x double")
    shares = {"lo": 0.01, "mid": 0.5, "hi": 0.99, "end": 1.0}
    want = df.groupBy("k").agg(*(F.percentile("x", p).alias(c) for c, p in shares.items()))
    got = places.quantiles(df, ["k"], F.col("x"), shares)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert "percentile" not in got._jdf.queryExecution().optimizedPlan().toString()

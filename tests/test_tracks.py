"""Kernels over recordings against plain loops."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.operators import tracks


def plain_cuts(t, m, most, end=None, smooth=2.0, search=0.3):
    """Tries every frame with the fewest parts left from each, counted by recursion."""
    n = len(t)
    step = float(np.median(np.diff(t))) if n > 1 else 1 / 30
    end = t[-1] + step if end is None else end
    bounds = [*t, end]
    left = [math.inf] * n + [0]
    for k in reversed(range(n)):
        left[k] = min((1 + left[j] for j in range(k + 1, n + 1) if bounds[j] <= t[k] + most + 1e-8), default=math.inf)
    if left[0] == math.inf:
        return "no cut fits"
    w = min(n, max(1, round(smooth / max(step, 1e-3))))
    mean = []
    for k in range(n):
        some = [m[j] if 0 <= j < n else 0.0 for j in range(k - w // 2, k + (w - 1) // 2 + 1)]
        mean.append(math.inf if any(not np.isfinite(v) for v in some) else float(np.array(some).sum() / w))
    quiet = np.percentile([v for v in mean if v < math.inf], 25) if min(mean) < math.inf else -math.inf
    out, prev = [], 0
    for i in range(1, left[0]):
        target = t[0] + i * (end - t[0]) / left[0]
        fit = [k for k in range(prev + 1, n) if t[k] <= t[prev] + most + 1e-8 and left[k] <= left[0] - i]
        fit = [k for k in fit if abs(t[k] - target) <= search * (end - t[0]) / left[0]] or fit
        k = min(fit, key=lambda k: (mean[k], abs(t[k] - target), k))
        out.append((k, round(float(t[k]), 9), bool(mean[k] <= quiet)))
        prev = k
    return out


def test_cuts_against_every_choice(spark):
    draw = random.Random(3)
    rows, want = [], {}
    for key in range(40):
        n, most = draw.randint(1, 60), 7.0
        t = np.cumsum([draw.choice([0.5, 1.0, 1.0, 2.0, 3.0] if key % 4 else [0.1, 0.25, 7.5]) for _ in range(n)])
        m = [draw.choice([0.0, 0.0, 1.0, 0.1, 2.5, None]) for _ in range(n)]
        rows += [(key, float(a), b) for a, b in zip(t, m)]
        want[key] = plain_cuts(t, [np.nan if v is None else v for v in m], most)
    rows += [(100, 1.0, 0.0), (100, 1.0, 0.0), (101, None, 0.0), (102, 0.0, 0.0), (102, 9.0, 0.0), (103, 0.0, 1.0)]
    want |= {100: "times", 101: "times", 102: "no cut fits", 103: []}
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "key int, t double, m double")
    got = {k: [] for k in want}
    for r in sorted(tracks.choose_cuts(df, ["key"], "t", "m", 7.0).collect(), key=lambda r: (r.key, r.frame or 0)):
        got[r.key] = r.problem if r.problem else [*got[r.key], (r.frame, round(r.t, 9), r.still)]
    assert got == want
    assert any(len(v) > 3 for v in want.values() if v not in ("times", "no cut fits")) and "no cut fits" in [want[k] for k in range(40)]
    assert tracks.choose_cuts(df.limit(0), ["key"], "t", "m", 7.0).count() == 0


def test_cuts_in_small_batches_are_those_of_one():
    draw = np.random.default_rng(5)
    t = np.cumsum(draw.uniform(0.02, 0.06, 3000))
    m = draw.exponential(1, 3000)

    def cuts(size):
        back = tracks.Backward(20.0, 2.0)
        const = (t[-1] + 0.04, float(np.median(np.diff(t))), len(t))
        parts = []
        for k in range(0, len(t), size):
            x = t[::-1][k : k + size]
            parts.append(back.add(x, m[::-1][k : k + size], *(np.full(len(x), c) for c in const)))
        rows = [np.concatenate(c)[::-1] for c in zip(*(p for p in [*parts, back.end()] if p))]
        forth, out = tracks.Forward(20.0, 0.3), []
        for k in range(0, len(t), size):
            got = forth.add(*(c[k : k + size] for c in rows), np.full(size, const[0]), np.full(size, 0.5))
            out += got[0].tolist() if got else []
            assert len(forth.t) <= 1100  # a part of frames, not the recording
        got = forth.end()
        return out + (got[0].tolist() if got else [])

    assert cuts(3000) == cuts(7) == cuts(256) == [k for k, _, _ in plain_cuts(t, m, 20.0, t[-1] + 0.04)]


def plain_euro(x, rate, dims):
    share = lambda cut: 1 / (1 + rate / (2 * math.pi * cut))

    def once(rows):
        y, v, out = None, None, []
        for r in rows:
            p = np.array(r).reshape(-1, dims)
            size = max(float(np.linalg.norm(p.max(0) - p.min(0))), 1.0)
            if y is None:
                y, v = p, 0 * p
            else:
                v = share(1.0) * (p - y) * rate + (1 - share(1.0)) * v
                a = np.array([[share(1.5 + 1.0 * float(np.linalg.norm(u)) / size)] for u in v])
                y = a * p + (1 - a) * y
            out.append(y.reshape(-1))
        return np.array(out)

    return (once(x) + once(x[::-1])[::-1]) / 2


def test_smoothing_runs_of_rows(spark):
    """Gaps, absent rows, a missing number, runs of one and two rows, one long run."""
    draw = np.random.default_rng(1)
    rows, runs = [], []
    for key, frames, gone in [("a", [*range(9), *range(12, 20)], {4}), ("b", [0], set()), ("c", [0, 1, 2, 5, 6], set()), ("d", list(range(300)), {100, 200})]:
        run = []
        for f in frames:
            x = draw.normal(0, 20, 6).tolist()
            if f in gone:
                x = [None, *x[1:]] if f % 200 == 0 else x
            rows.append((key, f, x, None if f == 100 else f not in gone))
            if f in gone or run and f != run[-1][0] + 1:
                runs.append((key, run))
                run = []
            if f not in gone:
                run.append((f, x))
        runs.append((key, run))
    want = {(k, f): x for k, f, x, _ in rows}
    for key, run in runs:
        if len(run) >= 3:
            want |= {(key, f): y.tolist() for (f, _), y in zip(run, plain_euro([x for _, x in run], 30.0, 2))}
    df = spark.createDataFrame(rows, "key string, frame long, x array<double>, ok boolean")
    got = tracks.smooth_both_ways(df, ["key"], "frame", "x", F.col("ok"), 30.0).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.x == pytest.approx(want[r.key, r.frame], abs=1e-9)
    assert tracks.smooth_both_ways(df.limit(0), ["key"], "frame", "x", F.col("ok"), 30.0).count() == 0


def best_fit(x, y, scale):
    """By the closed form of the greatest trace over turns without a mirror."""
    x, y = x - x.mean(0), y - y.mean(0)
    s = np.linalg.svd(x.T @ y, compute_uv=False)
    sign = np.linalg.det(x.T @ y)
    trace = s.sum() - (2 * s[-1] if sign < 0 else 0)
    return math.sqrt(max(0.0, ((x**2).sum() + (y**2).sum() - 2 * trace) / len(x))) / scale


def test_point_shapes(spark):
    draw = np.random.default_rng(8)
    base = draw.normal(0, 1, (6, 3))
    turn = np.linalg.qr(draw.normal(0, 1, (3, 3)))[0]
    turn *= np.linalg.det(turn)
    frames = [base, base @ turn + 5, base * 2, base * [1, 1, -1], base.copy(), base.copy(), draw.normal(0, 1, (6, 3)), base.copy()]
    frames[7][2, 1] = np.nan
    frames += [frames[7].copy(), np.full((6, 3), np.nan), np.zeros((6, 3))]
    rows = [("k", k, [None if np.isnan(v) else float(v) for v in f.reshape(-1)]) for k, f in enumerate(frames)] + [("none", 0, [None] * 18), ("k", 50, None)]
    df = spark.createDataFrame(rows, "key string, frame long, x array<double>")
    shapes = tracks.point_shapes(df, ["key"], "frame", "x").cache()
    got = {(r.key, r.frame): r for r in shapes.collect()}
    scale = math.sqrt(((base - base.mean(0)) ** 2).sum() / 6)
    assert got["k", 1].first == pytest.approx(0, abs=1e-7) and got["k", 2].first == pytest.approx(1, abs=1e-7)
    assert got["k", 3].first > 0.1  # a mirror is no turn
    for k, f in enumerate(frames[:9]):
        ok = np.isfinite(f).all(1) & np.isfinite(base).all(1)
        assert got["k", k].n_first == ok.sum() and got["k", k].first == pytest.approx(best_fit(base[ok], f[ok], scale), abs=1e-7)
        if k:
            both = np.isfinite(f).all(1) & np.isfinite(frames[k - 1]).all(1)
            assert got["k", k].adjacent == pytest.approx(best_fit(frames[k - 1][both], f[both], scale), abs=1e-7)
    assert [got["k", k].repeated for k in range(11)] == [False] * 5 + [True] + [False, False, True, False, False]
    assert (got["k", 0].adjacent, got["k", 0].n_adjacent, got["k", 9].first, got["k", 10].first, got["none", 0].first) == (None, 0, None, None, None)
    assert [(r.first, r.last, r.frames) for r in tracks.stale_spans(shapes, ["key"], "frame").orderBy("first").collect()] == [(4, 5, 2), (7, 8, 2)]
    bent = spark.createDataFrame([([*map(float, "000100110")],), ([*map(float, "000100200")],), ([0.0] * 9,), ([None] * 9,), (None,)], "x array<double>")
    assert [None if v is None else round(v, 6) for (v,) in bent.select(tracks.curl(F.col("x"), [0, 1, 2])).collect()] == [round(1 - math.sqrt(2) / 2, 6), 0.0, None, None, None]


def test_numbers_in_text():
    draw = random.Random(2)
    numbers = [0, 1, -1, 15, 16, -16, 31, 32, 1 << 40, -(1 << 40), *(draw.randint(-(10**6), 10**6) for _ in range(500))]
    assert tracks.unpacked_numbers(tracks.packed_numbers(numbers)) == numbers
    assert tracks.packed_numbers([0, 1, -1, 16]) == "ACDgB"
    with pytest.raises(ValueError):
        tracks.unpacked_numbers("g")


def test_times_come_back(spark):
    draw = random.Random(1)
    rows = [(key, round(float(x) / 1000, 3)) for key in range(5) for x in np.cumsum([draw.choice([33, 33, 34, 0, 5000, -0]) for _ in range(50 * key + 1)])]
    df = spark.createDataFrame([*rows, (9, None), (9, float("nan")), (9, 1e9), (0, -5.0)], "key int, t double")
    coded = tracks.encode_times(df, ["key"], "t", most=40).cache()
    got = {}
    for r in tracks.decode_times(coded, ["key"]).orderBy("key", "chunk", "k").collect():
        got.setdefault(r.key, []).append(r.ms)
    want = {}
    for k, t in [*rows, (9, 1e9), (0, -5.0)]:
        want.setdefault(k, []).append(round(t * 1000))
    assert got == {k: sorted(v) for k, v in want.items()}
    one = coded.where("key = 1 and chunk = 0").first()
    assert one.n == 40 and tracks.unpacked_numbers(one.data) == [b - a - one.step for a, b in zip(sorted(want[1])[:39], sorted(want[1])[1:40])]
    for broken in ("A", "g"):
        with pytest.raises(Exception, match="left over"):
            tracks.decode_times(coded.withColumn("data", F.concat("data", F.lit(broken))), ["key"]).collect()


def test_points_come_back_within_the_tolerance(spark):
    draw = np.random.default_rng(4)
    rows = []
    for key, frames in [("a", range(3, 40)), ("b", [0]), ("c", [1, 2, 7, 8, 9, 30]), ("d", range(500))]:
        x = np.cumsum(draw.normal(0, 0.3, (600, 4)), 0) * 3
        rows += [(key, f, x[f].tolist()) for f in frames]
    df = spark.createDataFrame([*rows, ("a", 60, [1.0, None, 2.0, 3.0]), ("a", 61, None), ("a", 62, [1.0, float("nan"), 2.0, 3.0])], "key string, frame long, x array<double>")
    coded = tracks.encode_points(df, ["key"], "frame", "x", most=64).cache()
    assert sorted((r.key, r.first, r.n) for r in coded.collect() if r.key in "abc") == [("a", 3, 37), ("b", 0, 1), ("c", 1, 2), ("c", 7, 3), ("c", 30, 1)]
    assert coded.where("key = 'd'").count() == 8
    got = {(r.key, r.frame): r.x for r in tracks.decode_points(coded, ["key"], "frame", "x", 4).collect()}
    assert set(got) == {(k, f) for k, f, _ in rows}
    assert max(abs(a - b) for k, f, x in rows for a, b in zip(x, got[k, f])) <= 1.0
    one = coded.where("key = 'a'").first()
    for broken in (one.data + "A", one.data[:-1]):
        with pytest.raises(ValueError):
            tracks.decoded_points(broken, one.first, one.n, 4)


def test_decoding_inverts_coding_for_every_step():
    draw = random.Random(9)
    for step, n, first in itertools.product([1, 2, 4, 7], [1, 2, 3, 9, 20], [0, 1, 5]):
        rows = [(first + k, [draw.uniform(-50, 50) for _ in range(3)]) for k in range(n)]
        got = tracks.decoded_points(tracks.coded_points(rows, step, 0.0), first, n, 3, step)
        assert [f for f, _ in got] == [f for f, _ in rows] and max(abs(a - b) for (_, x), (_, y) in zip(rows, got) for a, b in zip(x, y)) <= 1.0

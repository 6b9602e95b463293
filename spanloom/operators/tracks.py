"""Kernels over recordings: where to cut them, smoothing without lag, shapes, codecs.

Each streams (see ``scans``): ``choose_cuts`` holds one part and a smoothing window of a
recording, ``smooth_both_ways`` a row, ``point_shapes`` two frames, the codec one knot.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from spanloom.functions.numbers import DIGITS, number_text, text_numbers
from spanloom.operators.scans import Kernel, streamed
from spanloom.operators.signals import reading
from spanloom.session import stored

EPS = 1e-8


class Backward(Kernel):
    """Rows in descending time: the fewest parts from each frame to the end, and motion
    averaged over ``smooth`` seconds around it.  Holds one averaging window."""

    def __init__(self, most: float, smooth: float):
        self.most, self.smooth = most, smooth
        # first[r]: the earliest boundary from which r parts are enough; before: the last frame from which one more is.
        self.first, self.before, self.lost = [], None, False
        self.t = self.m = self.parts_of = np.zeros(0)
        self.done = 0

    def add(self, t, m, end, step, n):
        if not self.first:
            self.first = [end[0]]
            self.w = int(min(n[0], max(1, round(self.smooth / max(step[0], 1e-3)))))
        parts, k = np.full(len(t), np.nan), 0
        while k < len(t) and not self.lost:
            to = k + int(np.searchsorted(-t[k:], self.most + EPS - self.first[-1], "right"))
            if to > k:
                parts[k:to], self.before = len(self.first), t[to - 1]
            elif self.before is None:
                self.lost = True  # no frame reaches what follows it
            if to < len(t) and not self.lost:
                # The last frame reached is the first from which so many parts are enough.
                self.first.append(self.before)
                self.before = None
            k = to
        self.t, self.m, self.parts_of = (np.concatenate(p) for p in ((self.t, t), (self.m, m), (self.parts_of, parts)))
        return self.flush(False)

    def flush(self, last: bool):
        a, b = (self.w - 1) // 2, self.w // 2
        ready = len(self.t) if last else max(self.done, len(self.t) - b)
        if ready <= self.done:
            return None
        i = np.arange(self.done, ready)
        bad = ~np.isfinite(self.m)
        held = np.concatenate([np.zeros(a), np.where(bad, 0.0, self.m), np.zeros(b)])
        lost = np.concatenate([[0], np.cumsum(bad)])
        windows = np.lib.stride_tricks.sliding_window_view(held, self.w)
        mean = windows[i].sum(1) / self.w
        mean = np.where(lost[np.minimum(i + b + 1, len(bad))] > lost[np.maximum(i - a, 0)], np.inf, mean)
        out = self.t[i], mean, self.parts_of[i]
        keep = max(0, ready - a)
        self.t, self.m, self.parts_of, self.done = self.t[keep:], self.m[keep:], self.parts_of[keep:], ready - keep
        return out

    def end(self):
        return self.flush(True)


class Forward(Kernel):
    """Rows in ascending time: the quietest frame near each part's even share from which
    the parts left are enough.  Holds the frames that the next cut may take: one part."""

    def __init__(self, most: float, search: float):
        self.most, self.search, self.at, self.cuts = most, search, 0, 0
        self.t = self.m = self.parts = np.zeros(0)
        self.total = None

    def add(self, t, m, parts, end, quiet):
        if self.total is None:
            self.total, self.t0, self.quiet = parts[0], t[0], quiet[0]
            self.share = (end[0] - t[0]) / parts[0] if np.isfinite(parts[0]) else np.nan
            self.last, self.at = t[0], 1
            t, m, parts = t[1:], m[1:], parts[1:]
        if not np.isfinite(self.total):
            return None
        self.t, self.m, self.parts = (np.concatenate(p) for p in ((self.t, t), (self.m, m), (self.parts, parts)))
        return self.choose(False)

    def choose(self, last: bool):
        out = []
        while self.cuts < self.total - 1 and (last or len(self.t) and self.t[-1] > self.last + self.most + EPS):
            i = self.cuts + 1
            target = self.t0 + i * self.share
            k = np.flatnonzero((self.t <= self.last + self.most + EPS) & (self.parts <= self.total - i))
            near = k[np.abs(self.t[k] - target) <= self.search * self.share]
            k = near if len(near) else k
            k = k[np.lexsort((np.abs(self.t[k] - target), self.m[k]))[0]]
            out.append((self.at + k, self.t[k], self.m[k], self.m[k] <= self.quiet, target))
            self.last, self.at, self.cuts = self.t[k], self.at + k + 1, i
            self.t, self.m, self.parts = self.t[k + 1 :], self.m[k + 1 :], self.parts[k + 1 :]
        if self.cuts >= self.total - 1:
            self.t = self.m = self.parts = np.zeros(0)
            self.at = 0
        return tuple(np.array(c) for c in zip(*out)) if out else None

    def end(self):
        return self.choose(True) if self.total is not None and np.isfinite(self.total) else None


def choose_cuts(frames: DataFrame, keys: list[str], t: str, motion: str, most_s: float, end_s: str | None = None, smooth_s: float = 2.0, search: float = 0.3) -> DataFrame:
    """keys, frame (from 0), t, motion, still and target of the cuts that part each
    recording into as few parts of at most ``most_s`` seconds as can be, and problem.

    Cuts lie as near as ``search`` shares of a part's even length to where even parts
    would end, at the frame with the least motion (its mean over ``smooth_s`` seconds,
    a missing reading is infinite; ties: the nearest), but only where the parts that are
    left can still hold the rest.  still: under a quarter of the recording's motion.  A
    recording ends a median step (1/30 where it has one frame) after its last frame, or
    at ``end_s``.  One whose times are missing or don't increase, or that no cuts fit,
    has one row with its problem.  A recording that fits one part has no row.
    """
    if not 0 < most_s < float("inf"):
        raise ValueError("parts need a positive length")
    w = Window.partitionBy(*keys).orderBy(t)
    d = frames.select(*keys, reading(F.col(t)).alias("_t"), reading(F.col(motion)).alias("_m"), (reading(F.col(end_s)) if end_s else F.lit(None).cast("double")).alias("_e"))
    d = d.withColumn("_gap", F.col("_t") - F.lag("_t").over(Window.partitionBy(*keys).orderBy("_t")))
    of = d.groupBy(*keys).agg(F.count("*").alias("_n"), F.max("_t").alias("_z"), F.coalesce(F.percentile("_gap", 0.5), F.lit(1 / 30)).alias("_step"), F.max("_e").alias("_e"), F.bool_or(F.col("_t").isNull() | F.coalesce(F.col("_gap") <= 0, F.lit(False))).alias("_bad"))
    end = F.coalesce(F.col("_e"), F.col("_z") + F.col("_step"))
    of = stored(of.select(*keys, "_n", "_step", end.alias("_end"), F.coalesce(F.col("_bad") | (end <= F.col("_z")), F.lit(True)).alias("_bad")), "recordings")
    fine = d.drop("_e", "_gap").join(of.where("not _bad").drop("_bad"), keys)
    back = streamed(fine, keys, ["_t"], {c: F.col("_" + c) for c in ("t", "m", "end", "step", "n")}, lambda: Backward(most_s, smooth_s), "t double, mean double, parts double", descending=True)
    back = stored(back, "parts-left")
    quiet = back.groupBy(*keys).agg(F.coalesce(F.percentile(F.when(F.col("mean") < float("inf"), F.col("mean")), 0.25), F.lit(float("-inf"))).alias("_quiet"), F.bool_or(F.col("parts").isNull()).alias("_none"))
    known = back.join(quiet, keys).join(of.select(*keys, "_end"), keys)
    columns = {"t": F.col("t"), "m": F.col("mean"), "parts": F.col("parts"), "end": F.col("_end"), "quiet": F.col("_quiet")}
    cuts = streamed(known.where("not _none"), keys, ["t"], columns, lambda: Forward(most_s, search), "frame bigint, t double, motion double, still boolean, target double")
    cuts = cuts.withColumn("motion", F.when(F.col("motion") < float("inf"), F.col("motion")))
    faulty = of.where("_bad").select(*keys, F.lit("times").alias("problem")).unionByName(quiet.where("_none").select(*keys, F.lit("no cut fits").alias("problem")))
    return cuts.withColumn("problem", F.lit(None).cast("string")).unionByName(faulty, allowMissingColumns=True)


class OneEuro(Kernel):
    """One pass of a filter whose cut-off frequency rises with a point's speed."""

    def __init__(self, rate: float, least: float, beta: float, speed_cut: float, dims: int, with_first: bool):
        self.rate, self.least, self.beta, self.dims, self.with_first = rate, least, beta, dims, with_first
        self.keep = self.share(speed_cut)
        self.y = self.v = None

    def share(self, cut):
        return 1 / (1 + self.rate / (2 * np.pi * cut))

    def add(self, at, x, *first):
        out = np.empty_like(x)
        points = x.reshape(len(x), -1, self.dims)
        size = np.maximum(np.linalg.norm(points.max(1) - points.min(1), axis=-1), 1.0)
        for k, p in enumerate(points):
            if self.y is None:
                self.y, self.v = p, np.zeros_like(p)
            else:
                self.v = self.keep * (p - self.y) * self.rate + (1 - self.keep) * self.v
                a = self.share(self.least + self.beta * np.linalg.norm(self.v, axis=-1, keepdims=True) / size[k])
                self.y = a * p + (1 - a) * self.y
            out[k] = self.y.reshape(-1)
        return at, (out + first[0]) / 2 if self.with_first else out, *(() if self.with_first else (x,))


def smooth_both_ways(frames: DataFrame, keys: list[str], order: str, points: str, present: Column, rate: float, dims: int = 2, least_cut: float = 1.5, beta: float = 1.0, speed_cut: float = 1.0) -> DataFrame:
    """keys, ``order`` (a bigint, a row a step) and ``points`` smoothed without lag.

    points: arrays of numbers, ``dims`` a point, all of one length.  In every run of
    present rows (a missing number is an absent row) with no step left out, points are filtered forwards and backwards and
    the two are averaged; slow points are smoothed more, speed is counted in sizes of
    the set (its diagonal, at least 1).  Runs of under three rows and absent rows stay
    as they are.  Runs are dealt to tasks one by one, so a long recording is no hot key.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    x = F.transform(points, lambda v: v.cast("double"))
    here = F.coalesce(present, F.lit(False)) & F.col(points).isNotNull() & ~F.exists(x, lambda v: F.coalesce(F.isnan(v) | (F.abs(v) == float("inf")), F.lit(True)))
    d = frames.select(*keys, F.col(order).cast("long").alias("_k"), x.alias("_x"), here.alias("_here"))
    w = Window.partitionBy(*keys).orderBy("_k")
    new = F.coalesce(~F.lag("_here").over(w) | (F.col("_k") - F.lag("_k").over(w) > 1), F.lit(True))
    d = d.withColumn("_new", new).withColumn("_run", F.sum(F.col("_new").cast("int")).over(w))
    d = stored(d.withColumn("_n", F.count_if("_here").over(Window.partitionBy(*keys, "_run"))).withColumn("_go", F.col("_here") & (F.col("_n") >= 3)).drop("_new", "_n"), "runs")
    runs, make = [*keys, "_run"], lambda second: lambda: OneEuro(rate, least_cut, beta, speed_cut, dims, second)
    forth = streamed(d.where("_go"), runs, ["_k"], {"k": F.col("_k"), "x": F.col("_x")}, make(False), "k bigint, y array<double>, x array<double>")
    both = streamed(stored(forth, "forwards"), runs, ["k"], {"k": F.col("k"), "x": F.col("x"), "y": F.col("y")}, make(True), "k bigint, y array<double>", descending=True)
    rest = d.where("not _go").select(*keys, F.col("_k").alias(order), F.col("_x").alias(points))
    return both.select(*keys, F.col("k").alias(order), F.col("y").alias(points)).unionByName(rest)


class Shapes(Kernel):
    """Frames against the first and the one before, turned onto them without a mirror."""

    def __init__(self, dims: int, pair: tuple[int, int] | None):
        self.dims, self.pair, self.first, self.was = dims, pair, None, None

    def begin(self, x):
        ok = np.isfinite(x).all(1)
        if self.pair:
            a, b = self.pair
            scale = np.linalg.norm(x[b] - x[a]) if ok[[a, b]].all() else np.nan
        else:
            scale = np.sqrt(((x[ok] - x[ok].mean(0)) ** 2).sum(1).mean()) if ok.sum() >= self.dims else np.nan
        self.first, self.scale = x, scale if np.isfinite(scale) and scale > 0 else np.nan

    def distances(self, x, y):
        """Root mean square distances of the sets ``x`` turned onto ``y`` (a set each), by the
        scale, and how many points both have."""
        ok = np.isfinite(x).all(2) & np.isfinite(y).all(2)
        n = ok.sum(1)
        with np.errstate(invalid="ignore", divide="ignore"):
            centred = [np.where(ok[..., None], p - (np.where(ok[..., None], p, 0).sum(1) / n[:, None])[:, None], 0.0) for p in (x, y)]
        usable = (n >= self.dims) & np.isfinite(self.scale) & (np.abs(centred[0]) > 0).any((1, 2)) & (np.abs(centred[1]) > 0).any((1, 2))
        out = np.full(len(x), np.nan)
        if usable.any():
            p, q = centred[0][usable], centred[1][usable]
            u, _, vt = np.linalg.svd(p.transpose(0, 2, 1) @ q)
            mirror = np.linalg.det(u @ vt) < 0
            u[mirror, :, -1] *= -1
            far = ((p @ (u @ vt) - q) ** 2).sum(2).sum(1) / n[usable]
            out[usable] = np.sqrt(far) / self.scale
        return out, n

    def add(self, at, flat):
        x = flat.reshape(len(flat), -1, self.dims)
        if self.first is None:
            self.begin(x[0])
        before = np.concatenate([x[:1] if self.was is None else self.was[None], x[:-1]])
        d0, n0 = self.distances(np.broadcast_to(self.first, x.shape), x)
        d1, n1 = self.distances(before, x)
        same = ((before == x) | np.isnan(before) & np.isnan(x)).all((1, 2)) & (n1 >= self.dims)
        if self.was is None:
            d1[0], n1[0], same[0] = np.nan, 0, False
        self.was = x[-1]
        return at, d0, d1, n0, n1, same


def point_shapes(frames: DataFrame, keys: list[str], order: str, points: str, dims: int = 3, pair: tuple[int, int] | None = None) -> DataFrame:
    """keys, ``order``, first and adjacent (how far the set of points of a frame is from the
    first's and the one before, in the first's scale, after shifts and turns), n_first,
    n_adjacent (points that both have) and repeated (exactly the one before).

    points: arrays of ``dims`` numbers a point; a point with a missing number is not
    there, a frame without points is left out.  The scale is the distance of ``pair`` or the spread around the mean in the
    first frame; without one, or with fewer points than ``dims``, distances are null.
    """
    columns = {"k": F.col(order).cast("long"), "x": F.transform(points, lambda v: v.cast("double"))}
    frames = frames.where(F.col(points).isNotNull())
    out = "k bigint, first double, adjacent double, n_first bigint, n_adjacent bigint, repeated boolean"
    return streamed(frames, keys, [order], columns, lambda: Shapes(dims, pair), out).withColumnRenamed("k", order)


def stale_spans(shapes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """keys, first, last and frames of the runs in which each frame repeats the one before."""
    w = Window.partitionBy(*keys).orderBy(order)
    d = shapes.withColumns({"_was": F.lag(order).over(w), "_run": F.sum((~F.col("repeated")).cast("int")).over(w)})
    return d.where("repeated").groupBy(*keys, "_run").agg(F.min("_was").alias("first"), F.max(order).alias("last"), (F.count("*") + 1).alias("frames")).drop("_run")


def curl(points: Column, chain: list[int], dims: int = 3) -> Column:
    """One less the distance of a chain's ends by its length; null where a point is missing
    or the chain has no length."""
    at = [[F.get(points, F.lit(p * dims + d)).cast("double") for d in range(dims)] for p in chain]
    far = lambda a, b: F.sqrt(sum(((x - y) * (x - y) for x, y in zip(a, b)), F.lit(0.0)))
    whole = sum((far(a, b) for a, b in zip(at, at[1:])), F.lit(0.0))
    value = 1 - far(at[0], at[-1]) / whole
    return F.when((whole > 0) & (whole < float("inf")), F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


# Variable-length numbers and the codec of sampled points.

VALUE_OF = {c: k for k, c in enumerate(DIGITS)}


def packed_numbers(numbers) -> str:
    """Whole numbers, the sign in the lowest bit, then five bits a digit, low ones first."""
    out = []
    for n in numbers:
        v = (-n << 1) | 1 if n < 0 else n << 1
        while v > 31:
            out.append(DIGITS[32 | v & 31])
            v >>= 5
        out.append(DIGITS[v])
    return "".join(out)


def unpacked_numbers(text: str) -> list[int]:
    out, v, shift = [], 0, 0
    for c in text:
        d = VALUE_OF[c]
        v |= (d & 31) << shift
        shift += 5
        if d < 32:
            out.append(-(v >> 1) if v & 1 else v >> 1)
            v = shift = 0
    if shift:
        raise ValueError("the text ends within a number")
    return out


def coded_points(rows: list[tuple[int, list[float]]], step: int = 4, tolerance: float = 0.5) -> str:
    """The points (ascending frame, values) of one run of neighbouring frames: whole numbers
    at the run's ends and every ``step``-th frame, as differences from the knot before;
    between knots a line, with rounded deviations where one is greater than ``tolerance``."""
    frames = [f for f, _ in rows]
    knots = sorted({0, len(rows) - 1, *(k for k, f in enumerate(frames) if f % step == 0)})
    out, was, before = [], None, [0] * len(rows[0][1])
    for k in knots:
        here = [round(v) for v in rows[k][1]]
        out += [a - b for a, b in zip(here, before)]
        for j in range(was + 1, k) if was is not None else ():
            share = (frames[j] - frames[was]) / (frames[k] - frames[was])
            off = [v - (a + (b - a) * share) for v, a, b in zip(rows[j][1], before, here)]
            far = max(map(abs, off)) > tolerance
            out += [1, *map(round, off)] if far else [0]
        was, before = k, here
    return packed_numbers(out)


def decoded_points(text: str, first: int, n: int, width: int, step: int = 4) -> list[tuple[int, list[float]]]:
    """The inverse of ``coded_points``; numbers that are left over are an error."""
    held = iter(unpacked_numbers(text))
    take = lambda k: [next(held) for _ in range(k)]
    knots = sorted({0, n - 1, *(k for k in range(n) if (first + k) % step == 0)})
    out: dict[int, list[float]] = {}
    was, before = None, [0] * width
    try:
        for k in knots:
            here = [a + b for a, b in zip(take(width), before)]
            for j in range(was + 1, k) if was is not None else ():
                off = take(width) if take(1)[0] else [0] * width
                out[j] = [a + (b - a) * (j - was) / (k - was) + d for a, b, d in zip(before, here, off)]
            out[k], was, before = [float(v) for v in here], k, here
    except StopIteration:
        raise ValueError("the text ends before its points do") from None
    if next(held, None) is not None:
        raise ValueError("numbers are left over")
    return [(first + k, out[k]) for k in range(n)]


class Coder(Kernel):
    """Runs of neighbouring frames, coded in pieces of at most ``most`` frames."""

    def __init__(self, step: int, tolerance: float, most: int):
        self.step, self.tolerance, self.most, self.rows = step, tolerance, most, []

    def add(self, k, x):
        out = []
        for f, v in zip(k.tolist(), x.tolist()):
            if self.rows and (f != self.rows[-1][0] + 1 or len(self.rows) >= self.most):
                out.append(self.close())
            self.rows.append((f, v))
        return self.columns(out)

    def close(self):
        rows, self.rows = self.rows, []
        return rows[0][0], len(rows), coded_points(rows, self.step, self.tolerance)

    def columns(self, out):
        return tuple(np.array(c, dtype=object if j == 2 else np.int64) for j, c in enumerate(zip(*out))) if out else None

    def end(self):
        return self.columns([self.close()] if self.rows else [])


def encode_points(frames: DataFrame, keys: list[str], order: str, points: str, step: int = 4, tolerance: float = 0.5, most: int = 4096) -> DataFrame:
    """keys, first, n and data: every run of frames in text (see ``coded_points``), in pieces of
    at most ``most`` frames.  Rows with a missing number are not there."""
    x = F.transform(points, lambda v: v.cast("double"))
    whole = frames.where(F.col(order).isNotNull() & F.col(points).isNotNull() & ~F.exists(x, lambda v: F.coalesce(F.isnan(v) | (F.abs(v) == float("inf")), F.lit(True))))
    return streamed(whole, keys, [order], {"k": F.col(order).cast("long"), "x": x}, lambda: Coder(step, tolerance, most), "first bigint, n bigint, data string")


def decode_points(coded: DataFrame, keys: list[str], order: str, points: str, width: int, step: int = 4) -> DataFrame:
    """keys, ``order`` and ``points`` of every frame that ``encode_points`` coded; a piece
    that lacks numbers or has some left over is an error."""
    return coded.withColumn("_r", F.explode(decoded_column(width, step)("data", "first", "n"))).select(*keys, F.col("_r.k").alias(order), F.col("_r.x").alias(points))


def decoded_column(width: int, step: int):
    @F.pandas_udf("array<struct<k: bigint, x: array<double>>>")
    def decoded(data: pd.Series, first: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([[{"k": k, "x": x} for k, x in decoded_points(d, f, m, width, step)] for d, f, m in zip(data, first, n)])

    return decoded


def encode_times(df: DataFrame, keys: list[str], t: str, most: int = 4096) -> DataFrame:
    """keys, chunk, first (milliseconds), step (the commonest gap, the least of equals), n and
    data: what every gap differs from the step, as text; at most ``most`` times a chunk.
    Rows without a time are left out, repeated times stay."""
    ms = F.round(reading(F.col(t)) * 1000).cast("long")
    d = df.select(*keys, ms.alias("_ms")).where("_ms is not null")
    d = d.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy("_ms")) - 1).withColumn("chunk", F.floor(F.col("_k") / most).cast("int"))
    d = d.withColumn("_gap", F.col("_ms") - F.lag("_ms").over(Window.partitionBy(*keys, "chunk").orderBy("_k")))
    # A chunk is bounded, and so is what is gathered of it in one row.
    g = d.groupBy(*keys, "chunk").agg(F.min("_ms").alias("first"), F.coalesce(F.mode("_gap", True), F.lit(0)).alias("step"), F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(F.col("_gap").isNotNull(), F.struct("_k", "_gap")))).alias("_g"))
    text = F.array_join(F.transform("_g", lambda r: number_text(r["_gap"] - F.col("step"))), "")
    return g.select(*keys, "chunk", "first", "step", "n", text.alias("data"))


def decode_times(coded: DataFrame, keys: list[str]) -> DataFrame:
    """keys, chunk, k (place in the chunk) and ms of every time; a text whose numbers are not
    those of ``n`` times is an error."""
    gaps = text_numbers(F.col("data"))
    sound = F.when((F.size(gaps) == F.col("n") - 1) & ~F.col("data").rlike("[g-z0-9+/]$"), gaps).otherwise(F.raise_error(F.lit("a text of times lacks numbers or has some left over")).cast("array<bigint>"))
    back = F.aggregate(sound, F.array(F.col("first")), lambda a, g: F.concat(a, F.array(F.element_at(a, -1) + F.col("step") + g)))
    return coded.select(*keys, "chunk", F.posexplode(back).alias("k", "ms"))

"""Near-duplicate groups by min-max hashing, every link confirmed on full sets.

A text is the set of its word shingles.  Texts with equal sets are one node.
Each of 64 permutations gives two signature values, its minimum and its
maximum, so 128 values cost 64 evaluations a shingle.  Bands of 5 values (4 for
a threshold under 85 per cent) put sets of the threshold's similarity into a
common bucket but for about one pair in two million.
In a bucket of more than a few sets, each is compared with one pivot.  Those like it
are one group.  Those unlike it find partners in that group by their differences from
the pivot (see ``around_pivots``) and go on as a bucket with a pivot of their own.
In the last round all that are left are held against each other by their differences,
but not members of one component, so that no group is paired out and none is torn.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from spanloom.operators.components import components
from spanloom.llm.tokens import groups
from spanloom.llm.words import PLACES, free, mixed, shingles
from spanloom.session import stored

PERMUTATIONS = 64
SMALL = 6
#: Rounds of pivots; the last one holds all that are left against each other.
ROUNDS = 2
BROADCAST_ROWS = 1_000_000
_DRAW = np.random.default_rng(7)
MULTIPLY = _DRAW.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _DRAW.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def min_max(sets: list[np.ndarray]) -> np.ndarray:
    """Signatures of non-empty sets: the minima, then the maxima, of each permutation."""
    flat, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((len(sets), 2 * PERMUTATIONS), np.uint64)
    for k in range(PERMUTATIONS):
        p = flat * MULTIPLY[k] + ADD[k]
        out[:, k] = np.minimum.reduceat(p, starts)
        out[:, PERMUTATIONS + k] = np.maximum.reduceat(p, starts)
    return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band, different for equal values in other bands."""
    bands = 2 * PERMUTATIONS // rows
    spread = signatures[:, np.random.default_rng(11).permutation(2 * PERMUTATIONS)[: bands * rows]].reshape(-1, bands, rows)
    return mixed((spread * PLACES[:rows]).sum(2, dtype=np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * PLACES[63])


def node_of(s: np.ndarray) -> int:
    """A 64-bit hash of a set, whatever the order."""
    return int(mixed(np.array([mixed(s).sum(dtype=np.uint64)]) + np.uint64(len(s)))[0].view(np.int64))


def signed(docs: DataFrame, size: int, rows: int) -> DataFrame:
    """doc_id, tie (hash of the text), n, node (hash of the set; null: empty) and bands."""

    def sign(batches):
        for b in batches:
            at = 0
            for some in groups(b.column(2).to_pylist(), 1 << 18):
                sets = shingles(some, size)
                full = [k for k, s in enumerate(sets) if len(s)]
                nodes, keys = [None] * len(sets), [None] * len(sets)
                if full:
                    found = band_keys(min_max([sets[k] for k in full]), rows).view(np.int64)
                    for j, k in enumerate(full):
                        nodes[k] = node_of(sets[k])
                        keys[k] = found[j]
                cut = slice(at, at + len(some))
                at += len(some)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[cut], b.column(1)[cut], pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                    ["doc_id", "tie", "n", "node", "bands"],
                )

    return docs.mapInArrow(sign, "doc_id long, tie long, n long, node long, bands array<long>")


def full_sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """node, n, s (the set as an array) of the texts that stand for nodes, given
    as doc_id, tie."""
    wanted = stored(nodes.distinct(), "wanted")
    few = wanted.count() <= BROADCAST_ROWS
    some = docs.join(F.broadcast(wanted) if few else wanted, docs["doc_id"].eqNullSafe(wanted["doc_id"]) & (docs["tie"] == wanted["tie"]), "left_semi")

    def run(batches):
        for b in batches:
            for texts in groups(b.column(0).to_pylist(), 1 << 18):
                sets = [s for s in shingles(texts, size) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array(map(node_of, sets), pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "n", "s"])

    return stored(some.select("text").mapInArrow(run, "node long, n long, s array<long>").dropDuplicates(["node"]), "sets")


def compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with their sets, sizes na and nb, and whether they are linked."""
    one, two = (sets.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("s").alias(f"s{x}")) for x in "ab")
    both = pairs.join(one, "a").join(two, "b").withColumn("i", F.size(F.array_intersect("sa", "sb")).cast("long"))
    return both.withColumn("linked", F.col("i") * 100 >= (F.col("na") + F.col("nb") - F.col("i")) * percent)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose sets are alike enough."""
    sizes = sets.select("node", "n")
    one, two = (sizes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}")) for x in "ab")
    sized = pairs.join(one, "a").join(two, "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).select("a", "b")
    return compared(sized, sets, percent).where("linked").select("a", "b")


def around_pivots(star: DataFrame, percent: int, of: DataFrame | None = None) -> DataFrame:
    """Pairs of members of one pivot that may be alike, one of them like the pivot
    and one not; given ``of`` (node and component: equal ones are known to be linked)
    also pairs of two that are not, of different components.

    star: a (member), b (pivot), na, nb, linked and d, the symmetric difference of
    their sets.  Members x and y are alike where |x diff y| <= q (|x| + |y|), and
    |x diff y| = |d(x)| + |d(y)| - 2 |d(x) & d(y)|, so their differences must share
    at least s = (|d(x)| + |d(y)| - q (|x| + |y|)) / 2 elements.  As y is not like
    the pivot, s exceeds half of |d(x)| (less what x is longer than the pivot); as
    |d(y)| >= |d(x)| - |x diff y|, it is at least |d(x)| - q (|x| + |y|), too.  So one
    of the rarest |d(x)| - s + 1 elements of d(x) is among them, and prefixes in
    order of rarity find every such pair.  What copies changed each for themselves
    is rare, so hardly any other pair is found.
    """
    q = (100 - percent) / (100 + percent)
    apart = star.groupBy("b").agg(F.bool_and("linked").alias("all"), F.bool_or("linked").alias("some")).where("some and not all" if of is None else "not all").select("b")
    star = star.withColumn("component", F.col("a")) if of is None else star.join(of.withColumnRenamed("node", "a"), "a", "left").withColumn("component", F.coalesce("component", "a"))
    long = star.join(apart, "b", "left_semi").select("a", "b", "na", "nb", "linked", "component", F.size("d").alias("nd"), F.explode("d").alias("w"))
    often = long.groupBy("b", "w").agg(F.count("*").alias("f"))
    place = F.row_number().over(Window.partitionBy("b", "a").orderBy("f", "w"))
    # Whoever is alike is no longer than na * 100 / percent, which bounds s for either side.
    either = F.greatest(F.lit(1), F.ceil(F.col("nd") - q * F.col("na") * (1 + 100 / percent) - 1e-9))
    least = F.greatest(either, F.floor((F.col("nd") - q * F.greatest(F.col("na") - F.col("nb"), F.lit(0))) / 2 - 1e-9) + 1)
    placed = long.join(often, ["b", "w"]).withColumn("k", place).where((F.col("f") > 1) & (F.col("k") <= F.col("nd") - either + 1))
    placed = stored(placed.withColumn("first", F.col("k") <= F.col("nd") - least + 1), "differences")
    if of is None:
        sides = [("linked", "not linked")]
    else:
        # Of an element's holders the largest component is not paired with itself.
        size = F.count("*").over(Window.partitionBy("b", "w", "component"))
        most = F.max(F.struct("n", "component")).over(Window.partitionBy("b", "w"))
        placed = placed.repartition("b", "w").withColumn("n", size).withColumn("rest", F.col("component") != most["component"])
        sides = [("rest", "not linked"), ("not rest", "not linked and rest")]
    s = F.ceil((F.col("dx") + F.col("dy") - q * (F.col("nx") + F.col("ny"))) / 2 - 1e-9)
    fits = (F.col("kx") <= F.col("dx") - s + 1) & (F.col("ky") <= F.col("dy") - s + 1) & (F.least("nx", "ny") * 100 >= F.greatest("nx", "ny") * percent) & (F.col("cx") != F.col("cy"))
    out = None
    for one, two in sides:
        x = placed.where("first").where(one).select("b", "w", F.col("a").alias("x"), F.col("na").alias("nx"), F.col("nd").alias("dx"), F.col("k").alias("kx"), F.col("component").alias("cx"))
        y = placed.where(two).select("b", "w", F.col("a").alias("y"), F.col("na").alias("ny"), F.col("nd").alias("dy"), F.col("k").alias("ky"), F.col("component").alias("cy"))
        met = x.join(y, ["b", "w"]).where(fits).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        out = met if out is None else out.unionByName(met)
    return out.distinct()


def pivots_of(links: list[DataFrame]) -> DataFrame:
    """node and component: the least of the nodes that it is linked with as ``b``, itself for
    those.  Members of a group have the same pivot in most of their buckets."""
    edges = reduce(DataFrame.unionByName, links)
    ends = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    rest = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return rest.join(ends.select("node"), "node", "left_anti").unionByName(ends)


def grouped(docs: DataFrame, size: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """doc_id, tie (hash of the text), n, node (null: no words) and leader, the
    first (no_id, doc_id, tie) of the row's group, for every row of ``docs``."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.xxhash64(text).alias("tie"))
    sigs = stored(signed(rows.select("doc_id", "tie", "text"), size, 5 if percent >= 85 else 4), "signatures")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie")
    reps = sigs.where("node is not null").groupBy("node").agg(F.min(first).alias("r"), F.any_value("bands").alias("bands"))
    keyed = stored(reps, "nodes")
    in_band = keyed.select("node", F.explode("bands").alias("key"))
    shared = in_band.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    found = stored(in_band.join(shared, "key"), "buckets")
    met = found.groupBy("node").agg(F.sum("members").alias("met"))
    sets = full_sets(rows, keyed.join(met.select("node"), "node", "left_semi").select("r.doc_id", "r.tie"), size)
    difference = F.concat(F.array_except("sa", "sb"), F.array_except("sb", "sa"))
    few, left = found.where(F.col("members") <= SMALL).select("key", "node"), found.where(F.col("members") > SMALL).join(met, "node").select("key", "node", "met")
    near: list[DataFrame] = []
    joined = lambda: reduce(DataFrame.unionByName, near)
    for turn in range(1, ROUNDS + 1):
        # Small buckets: their few pairs.
        direct = few.select("key", F.col("node").alias("a")).join(few.select("key", F.col("node").alias("b")), "key").where("a < b").select("a", "b").distinct()
        near.append(stored(confirmed(direct, sets, percent), "links"))
        left = stored(left, "left")
        if left.isEmpty():
            break
        # Others: each member with the pivot, the member that meets most others in its buckets, and around it.
        pivots = left.groupBy("key").agg(F.max(F.struct("met", "node")).alias("p")).select("key", F.col("p.node").alias("b"))
        members = left.withColumnRenamed("node", "a").join(pivots, "key").where("a <> b")
        star = stored(compared(members.select("a", "b").distinct(), sets, percent).select("a", "b", "na", "nb", "linked", difference.alias("d")), "stars")
        near.append(star.where("linked").select("a", "b"))
        pairs = around_pivots(star, percent, pivots_of(near) if turn == ROUNDS else None)
        near.append(stored(confirmed(pairs, sets, percent), "links"))
        if turn < ROUNDS:
            apart = members.join(star.where("not linked").select("a", "b"), ["a", "b"]).select("key", F.col("a").alias("node"), "met")
            apart = stored(apart.join(apart.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "key"), "apart")
            few, left = apart.where(F.col("members") <= SMALL).select("key", "node"), apart.where(F.col("members") > SMALL).select("key", "node", "met")
    edges = stored(joined().distinct(), "links")
    of = components(edges)
    linked = keyed.select("node", "r").join(of, "node")
    leaders = stored(linked.join(linked.groupBy("component").agg(F.min("r").alias("leader")), "component").select("node", "leader"), "leaders")
    out = sigs.select("doc_id", "tie", "n", "node").join(keyed.select("node", "r"), "node", "left").join(leaders, "node", "left")
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie")
    return out.select("doc_id", "tie", "n", "node", F.coalesce("leader", "r", own).alias("leader"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    Two texts are linked where 100 * |intersection| >= ``percent`` * |union| of
    their sets of ``size``-word shingles.  component_id is the smallest doc_id
    that links reach, itself included; kept says whether it is the row's own.
    A text with fewer words is one shingle; a null or empty text has none and is
    linked with nothing.  Equal texts are linked.  A null doc_id is never
    smallest unless there is no other.  Rows that repeat stay.
    """
    found = grouped(docs, size, percent, doc_id, text)
    component = F.col("leader.doc_id")
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near duplicates, that of the
    smallest doc_id (ties by a hash of the text; null ids last).  Texts without
    words all stay.  All columns are kept."""
    found = stored(grouped(docs, size, percent, doc_id, text), "groups")
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie")
    k = free(docs, "_k")
    key = F.xxhash64("doc_id", "tie").alias(k)
    gone = found.where(~own.eqNullSafe(F.col("leader"))).select(key).distinct()
    again = found.where("node is not null").groupBy("doc_id", "tie").count().where("count > 1").select(key).distinct()
    tagged = docs.withColumn(k, F.xxhash64(F.col(doc_id).cast("long"), F.xxhash64(text)))
    small = lambda d: F.broadcast(d) if d.count() <= BROADCAST_ROWS else d
    gone, again = small(stored(gone, "gone")), stored(again, "repeated")
    left = tagged.join(gone, k, "left_anti")
    if not again.isEmpty():  # rows that repeat exactly: one of them stays
        once = left.join(small(again), k, "left_semi").dropDuplicates([k])
        left = left.join(small(again), k, "left_anti").unionByName(once)
    return left.drop(k)

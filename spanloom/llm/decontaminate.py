"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over a window of words; places with 0 are ignored, so a
substituted word there does not hide a match.  Hashes of all masked windows of
the benchmark are joined with those of the documents on the map side; around
each hit, item and text are laid side by side and the share of equal words in
the best window decides.  The benchmark goes out in blocks of bounded size, one
pass over the documents for each.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spanloom.llm.tokens import groups
from spanloom.llm.words import PLACES, free, windows, word_hashes
from spanloom.session import stored

#: Fixed masks of weight 6; the shortest spans 7 words.
MASKS = ("1111011", "11011011", "110100111", "1110010011")
BLOCK_TOKENS = 1 << 19
LEAST_WORDS = 5
WINDOW, PERCENT = 13, 80
FILTER_BITS = 22


def places(mask: str) -> list[int]:
    return [k for k, x in enumerate(mask) if x == "1"]


def masks_of(n: int, percent: int) -> list[str]:
    """Masks of which one at least meets every verifying overlap with an item of
    n words: from 12 words on the fixed ones, for shorter items all of its own
    length that ignore as many words as may differ."""
    if n >= 12:
        return list(MASKS)
    return ["".join("0" if k in gaps else "1" for k in range(n)) for gaps in combinations(range(n), n * (100 - percent) // 100)]


def seeds(h: np.ndarray, percent: int) -> list[tuple[str, np.ndarray]]:
    """(mask, hashes) of every masked window of an item."""
    return [(m, windows(h, places(m)) + PLACES[len(m)]) for m in masks_of(len(h), percent)]


class Index:
    """A block of the benchmark: seed hashes, sorted, with their items and places."""

    def __init__(self, items: list[tuple[int, str]], percent: int):
        self.ids = [i for i, _ in items]
        h, ends = word_hashes([t for _, t in items], stripped=True)
        self.words = [h[a:b] for a, b in zip(ends[:-1], ends[1:])]
        keys, who, where, self.masks = [], [], [], set()
        for k, w in enumerate(self.words):
            if len(w) < LEAST_WORDS:
                continue
            for mask, s in seeds(w, percent):
                self.masks.add(mask)
                keys.append(s)
                who.append(np.full(len(s), k))
                where.append(np.arange(len(s)))
        cat = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
        keys, who, where = cat(keys, np.uint64), cat(who, np.int64), cat(where, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.who, self.where = keys[order], who[order], where[order]
        self.some = np.zeros(1 << FILTER_BITS, bool)
        self.some[(self.keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def hits(self, h: np.ndarray):
        """(place in h, seed's place in self.keys) of all windows that meet a seed."""
        for mask in self.masks:
            s = windows(h, places(mask)) + PLACES[len(mask)]
            at = np.flatnonzero(self.some[(s >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            lo, hi = np.searchsorted(self.keys, s[at], "left"), np.searchsorted(self.keys, s[at], "right")
            for k in np.flatnonzero(hi > lo):
                for j in range(lo[k], hi[k]):
                    yield int(at[k]), j


def overlap(doc: np.ndarray, item: np.ndarray, shift: int, window: int) -> tuple[int, int, int] | None:
    """(start in doc, words, equal words) of the best window of item laid at doc[shift:]."""
    a, b = max(0, -shift), min(len(item), len(doc) - shift)
    same = doc[a + shift : b + shift] == item[a:b]
    n = min(window, len(item))
    if len(same) < n:
        return None
    sums = np.convolve(same, np.ones(n, int), "valid")
    k = int(sums.argmax())
    return a + shift + k, n, int(sums[k])


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, percent: int = PERCENT) -> DataFrame:
    """doc_id, item_id, start, words and equal_words: for each document row and
    item at most one row, the best overlap that verifies.  Items with equal texts
    count as one, under the smallest of their ids.

    Words are lower-cased (A-Z) and stripped of punctuation at their ends.  An
    overlap verifies where, laid side by side without shifts, ``window`` words
    in a row (all of a shorter item) are equal in at least ``percent`` per cent.
    Items of fewer than 5 words are no evidence and match nothing; neither does a
    document with fewer words than that (a short piece of a longer item is no
    overlap), nor a null or empty text; rows with a null item_id are items too.  Rows that
    repeat give repeated results.  start counts words from 0.
    """
    spark = docs.sparkSession
    # Items of one text are one class: repeats of an item would repeat every hit.
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("text")).groupBy("text").agg(F.min("item_id").alias("item_id"))
    size = items.agg(F.coalesce(F.sum(F.size(F.split("text", "\\s+"))), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_TOKENS))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    out = None
    for k in range(blocks):
        held = [(r["item_id"], r["text"]) for r in dealt.where(F.col("block") == k).orderBy("item_id", "text").toLocalIterator()]
        index = spark.sparkContext.broadcast(held)
        found = rows.mapInArrow(matcher(index, window, percent), "doc_id long, item_id long, start long, words long, equal_words long")
        out = found if out is None else out.unionByName(found)
    return out


_INDEX: dict = {}


def index_of(shared, percent: int) -> Index:
    """This worker's index of a broadcast block (one is kept)."""
    key = (percent, shared.value)
    if _INDEX.get("key") != key:
        _INDEX.update(key=key, index=Index(shared.value, percent))
    return _INDEX["index"]


def matcher(shared, window: int, percent: int):
    names = ["doc_id", "item_id", "start", "words", "equal_words"]

    def run(batches):
        index = index_of(shared, percent)
        for b in batches:
            found: list[tuple] = []
            ids, at = b.column(0).to_pylist(), 0
            for some in groups(b.column(1).to_pylist()):
                h, ends = word_hashes(some, stripped=True)
                tried: dict = {}
                for place, j in index.hits(h):
                    d = int(np.searchsorted(ends, place, "right")) - 1
                    who = int(index.who[j])
                    shift = place - int(index.where[j]) - int(ends[d])
                    if (d, who, shift) in tried:
                        continue
                    got = overlap(h[ends[d] : ends[d + 1]], index.words[who], shift, window)
                    tried[d, who, shift] = got if got and got[2] * 100 >= percent * got[1] else None
                best: dict = {}
                for (d, who, _), got in tried.items():
                    if got and ((d, who) not in best or (-got[2], got[0]) < (-best[d, who][2], best[d, who][0])):
                        best[d, who] = got
                found += [(ids[at + d], index.ids[who], *got) for (d, who), got in sorted(best.items())]
                at += len(some)
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(5)], names)

    return run


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text overlaps no benchmark item; all columns stay.

    Rows are told apart by doc_id and text together, so a null or repeated
    doc_id is no obstacle.
    """
    k = free(docs, "_k")
    tagged = docs.withColumn(k, F.xxhash64(F.col(doc_id), F.col(text)))
    bad = stored(contaminated(tagged.select(F.col(k).alias("k"), F.col(text).alias("t")), benchmark, "k", "t", **options).select(F.col("doc_id").alias(k)).distinct(), "contaminated")
    return tagged.join(F.broadcast(bad) if bad.count() <= 1_000_000 else bad, k, "left_anti").drop(k)

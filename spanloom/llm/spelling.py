"""Spelling variants: words one edit apart, each tied to a much commoner one.

Words that differ by one inserted, deleted or replaced code point share all that
stands before the edit and all that stands after it, so a half of them is intact:
they stand side by side in the dictionary sorted forwards (a shared prefix) or in
the one sorted by reversed words (a shared suffix).  Both dictionaries are cut by
range and scanned block by block.  A block of more than ``most`` words is divided
in the same way: of what is left between the shared ends one half is intact again,
so its words go on into a block of a longer prefix and one of a longer suffix.
What can't be divided any more differs in one place only, by as many words as
there are letters.  Every pair belongs to exactly one block, where it is verified.

A block is (kind, m, head, tail, less): pairs of words of m code points that differ
by a replacement (kind 0), or of m and m + 1 by an insertion (kind 1, ``long`` says
which), that begin with head and end with tail and, for kind 1, have fewer than
``less`` leading code points in common: others are in the block of the longer head.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spanloom.session import stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Distinct words that a task holds before it hands its counts on.
HELD = 200_000
#: Numbers of a comparison that are laid out at once.
CELLS = 1 << 22
BROADCAST_ROWS = 1_000_000
BLOCK = ["kind", "m", "less", "head", "tail"]


def runs_of(text: str, doc_id: str, every: int) -> Counter:
    """Counts of a text's lower-cased runs of letters; one in ``every`` of them (by
    the crc32 of ``doc_id:run``) has lost a code point."""
    out: Counter = Counter()
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(RUN.findall(text)).items():
        low = run.lower() if run.isascii() else run.translate(UPPER)
        h = zlib.crc32(low.encode(), start)
        if h % every == 0:
            k = h % len(low)
            low = low[:k] + low[k + 1 :]
        out[low] += n
    return out


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = 199, least_length: int = 6, least_count: int = 5) -> DataFrame:
    """word, n of all words of at least ``least_length`` code points that occur at
    least ``least_count`` times in all texts."""

    def counted(batches):
        found: Counter = Counter()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for w, n in runs_of(t or "", i or "", every).items():
                    if len(w) >= least_length:
                        found[w] += n
                if len(found) > HELD:
                    yield rows()
                    found.clear()
        yield rows()

    parts = docs.select(F.col(doc_id).cast("string"), text).mapInArrow(counted, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def divided(blocks: DataFrame) -> DataFrame:
    """Each row in its two blocks of longer ends.  One replaced place lies in one half
    of what is left; where insertions fit both, the longer head has the pair."""
    i, j, size = F.length("head"), F.length("tail"), F.length("word")
    left = F.col("m") - i - j
    half = F.floor((left + F.col("kind")) / 2).cast("int")
    ahead, behind = i + half, j + left - half + F.col("kind")
    forward = F.struct(F.substring("word", F.lit(1), ahead).alias("head"), F.col("tail").alias("tail"), F.col("less").alias("less"))
    backward = F.struct(F.col("head").alias("head"), F.substring(F.col("word"), size - behind + 1, behind).alias("tail"), F.when(F.col("kind") == 1, ahead).otherwise(F.col("less")).alias("less"))
    out = blocks.withColumn("_b", F.explode(F.array(forward, backward)))
    return keyed(out.select("word", "n", "kind", "m", "long", "_b.head", "_b.tail", "_b.less"))


def keyed(blocks: DataFrame) -> DataFrame:
    return blocks.withColumn("key", F.xxhash64(*BLOCK))


def undivided(words: DataFrame) -> DataFrame:
    """Every word as one that may have a letter replaced, as the shorter and as the longer one."""
    size = F.length("word")
    as_ = lambda kind, m, long: F.struct(F.lit(kind).alias("kind"), m.alias("m"), F.lit(long).alias("long"))
    roles = F.explode(F.array(as_(0, size, False), as_(1, size, False), as_(1, size - 1, True)))
    out = words.withColumn("_r", roles).select("word", "n", "_r.*").where("m > 0")
    return out.withColumns({"head": F.lit(""), "tail": F.lit(""), "less": F.col("m") + 1})


def letters(words: list[str], width: int) -> np.ndarray:
    return np.array(words, f"U{max(1, width)}").view(np.uint32).reshape(len(words), -1)[:, :width]


def near_in_block(kind: int, m: int, less: int, head: int, tail: int, short: list[str], long: list[str]) -> np.ndarray:
    """Which of the words ``short`` are one edit from which of ``long`` (kind 0: the same
    list); words of one block, head and tail are lengths."""
    left = m - head - tail
    a = letters([w[head : len(w) - tail] for w in short], left)
    if kind == 0:
        return (a[:, None, :] != a[None, :, :]).sum(2) == 1
    b = letters([w[head : len(w) - tail] for w in long], left + 1)
    ahead = np.logical_and.accumulate(a[:, None, :] == b[None, :, :left], 2).sum(2)
    behind = np.logical_and.accumulate(a[:, None, ::-1] == b[None, :, :0:-1], 2).sum(2)
    near = ahead + behind >= left
    if less <= m:
        to = less - head
        near &= ~(letters([w[head:less] for w in short], to)[:, None, :] == letters([w[head:less] for w in long], to)[None, :, :]).all(2)
    return near


def verified(block: dict) -> list[tuple]:
    """(word, n_near, near_n, near) for words of a block (in ascending order) that have near
    ones in it; near is the commonest, ties to the smallest."""
    kind, m, less, head, tail, rows = block["kind"], block["m"], block["less"], block["head"], block["tail"], block["rows"]
    short = [r for r in rows if not r[2]]
    sides = [(short, short)] if kind == 0 else [(short, [r for r in rows if r[2]])]
    out = []
    for a, b in sides:
        if not a or not b or (kind == 0 and len(a) < 2):
            continue
        step = max(1, CELLS // (len(b) * max(1, m - head - tail + 1)))
        best = None
        for k in range(0, len(a), step):  # a block of very long words is compared in strips
            some = a[k : k + step]
            if kind == 0 and step < len(a):
                near = np.array([[x[0] != y[0] and sum(p != q for p, q in zip(x[0], y[0])) == 1 for y in b] for x in some])
            else:
                near = near_in_block(kind, m, less, head, tail, [r[0] for r in some], [r[0] for r in b])
            if not near.any():
                continue
            out += commonest(some, b, near)
            if kind == 1:
                found = {r[0]: r for r in commonest(b, some, near.T)}
                best = found if best is None else {w: merged(best.get(w), found.get(w)) for w in best.keys() | found.keys()}
        out += list((best or {}).values())
    return out


def merged(a: tuple | None, b: tuple | None) -> tuple:
    if a is None or b is None:
        return a or b
    n, w = min((-a[2], a[3]), (-b[2], b[3]))
    return a[0], a[1] + b[1], -n, w


def commonest(some: list[tuple], others: list[tuple], near: np.ndarray) -> list[tuple]:
    count = near.sum(1)
    order = sorted(range(len(others)), key=lambda k: (-others[k][1], others[k][0]))
    first = near[:, order].argmax(1)
    return [(some[k][0], int(count[k]), others[order[first[k]]][1], others[order[first[k]]][0]) for k in np.flatnonzero(count)]


def scanned(blocks: DataFrame) -> DataFrame:
    """word, n_near, near_n, near: each block of the sorted dictionaries verified."""
    order = ["kind", "m", "less", "head", F.reverse("tail"), "tail"]
    laid = blocks.repartitionByRange(*order).sortWithinPartitions(*order, "word", "long").select("key", *BLOCK, "word", "n", "long")
    fields = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())])

    def scan(batches):
        block, found = {"key": None, "rows": []}, []
        for b in batches:
            key = b.column(0).to_numpy()
            starts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)] if len(key) else []
            for s, e in zip(starts[:-1], starts[1:]):
                if key[s] == block["key"]:
                    block["rows"] += rows_of(b, s, e)
                    continue
                found += verified(block) if len(block["rows"]) > 1 else []
                if e - s == 1 and e < len(key):
                    block = {"key": None, "rows": []}  # alone
                    continue
                head, tail = b.column(4)[s].as_py(), b.column(5)[s].as_py()
                block = {"key": key[s], "kind": b.column(1)[s].as_py(), "m": b.column(2)[s].as_py(), "less": b.column(3)[s].as_py(), "head": len(head), "tail": len(tail), "rows": rows_of(b, s, e)}
            if len(found) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), fields)], schema=fields)
                found = []
        found += verified(block) if len(block["rows"]) > 1 else []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), fields)], schema=fields)

    def rows_of(b, s: int, e: int) -> list[tuple]:
        return list(zip(*(b.column(k).slice(s, e - s).to_pylist() for k in (6, 7, 8))))

    return laid.mapInArrow(scan, "word string, n_near long, near_n long, near string")


def near_words(words: DataFrame, most: int = 256) -> DataFrame:
    """word, n_near, near_n and near for every word with words one edit apart.

    words: word (distinct, of at least two code points) and n.  n_near counts the
    near words, near is the commonest of them (ties: the smallest in code-point
    order) and near_n its n.
    """
    level = divided(undivided(words))
    found = []
    while True:
        level = stored(level, "blocks")
        # A block whose words have one place left is as wide as the alphabet and stays whole.
        open_ = F.col("m") - F.length("head") - F.length("tail") > 1 - F.col("kind")
        wide = stored(level.where(open_).groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > most).select("key"), "wide-blocks")
        n = wide.count()
        if not n:
            found.append(stored(scanned(level), "near-words"))
            break
        wide = F.broadcast(wide) if n <= BROADCAST_ROWS else wide
        found.append(stored(scanned(level.join(wide, "key", "left_anti")), "near-words"))
        level = divided(level.join(wide, "key", "left_semi").drop("key"))
    best = F.min(F.struct((-F.col("near_n")).alias("k"), "near"))
    return reduce(DataFrame.unionByName, found).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.k")).alias("near_n"), "b.near")


def roots_of(forms: DataFrame) -> DataFrame:
    """word and root, the end of the chain of forms.  forms: word, form, where a form
    occurs ``ratio`` times as often as its word, so no chain is long or a ring; each
    round doubles the step."""
    ahead = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = ahead.join(ahead.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
        step = stored(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        ahead = step.select("word", "root")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = 199, least_length: int = 6, least_count: int = 5, ratio: int = 5, most: int = 256) -> DataFrame:
    """word, form, root, n, n_near and form_n for every word of all whole texts.

    Words are maximal runs of Latin letters, A-Z lower-cased, of which one in
    ``every`` (by document and run) has lost a code point; those of at least
    ``least_length`` (2 or more) code points and ``least_count`` occurrences count.
    form is the commonest word one edit away (ties: the smallest) if it occurs at
    least ``ratio`` (2 or more) times as often, else null; root is where forms lead
    to, the word itself without one.  A null text has no words, a null id is written
    as nothing; repeated rows count again; other columns are not read; an empty
    table gives no rows.  ``most`` bounds the blocks that are compared, not the result.
    """
    if least_length < 2 or ratio < 2:
        raise ValueError("words need two code points, forms twice the occurrences")
    words = stored(count_words(docs, doc_id, text, every, least_length, least_count), "words")
    tied = words.join(near_words(words, most), "word", "left")
    known = F.col("near_n") >= F.col("n") * ratio
    tied = stored(tied.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(known, F.col("near")).alias("form"), F.when(known, F.col("near_n")).alias("form_n")), "forms")
    roots = roots_of(tied.where("form is not null"))
    return tied.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

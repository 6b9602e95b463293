"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text is its lower-cased words and one end.  It is coded as binary decisions:

* Passages.  Texts are cut where a hash of two words says so, every PASSAGE words
  on average.  Does the next passage follow this one in another training text,
  or stand in one at all?  If so, its share of what is known there is its price.
* Words of other passages: the path in a Huffman tree over the commonest training
  words and an escape; after the escape byte by byte in a Huffman tree over bytes.

Three contexts predict each decision on a path (words: none, the last very common
word, the word before; bytes: the word so far, the two bytes before with that
common word, the four bytes before).  A context and a tree node hash to a slot
with counts of zeros and ones over the training texts.  Their log odds are mixed
with weights chosen by a gate (kind of decision, depth in the tree, which contexts
are known), and the mix is refined by an offset chosen by the mix itself.  Weights
and offsets are learned from every training text, before the slots of its task have
seen it, and go on learning along each text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from spanloom.session import stored

#: Slots (as powers of two) of the contexts: words 0-2, bytes 3-5.
SLOT_BITS, BLOCK_BITS = (16, 19, 21, 21, 20, 21), 16
COMMON, KNOWN_BEFORE = 64, 8192
PRIOR, QUANT = 0.4, 12.0
RATE, OFFSET_RATE, STEADY = 1.0, 0.5, 30.0
PASSAGE, SPACE = 32, 32
#: Decisions of a path; what is left of a longer one has its share of what is below there.
HEAD = 14
#: Bounds of what is broadcast: keys with their counts, and of them words in the tree.
FREQUENT, TREE_WORDS = 1 << 20, 1 << 18
#: Rarer words are spelled: their letters foretell more than their few repeats.
LEAST_COUNT = 6
U, W = np.uint32, np.uint64
_DRAW = np.random.default_rng(20240502)
BYTE_HASH = _DRAW.integers(1, 1 << 63, 256, dtype=W) * W(2) + W(1)
POWER = 0x9E3779B97F4A7C15
#: Gates: 16 of words (depth by what is known), 16 of bytes, 8 of each passage decision.
GATES, WORDS, BYTES, FOLLOWS, KNOWN = 48, 0, 16, 32, 40
#: Offsets: 16 of each kind (words, bytes, passages), which begin where the kind's gates do.
OFFSETS = GATES
#: Sums of one text's bins, which are added to in turn.
LANES = 8
#: Key of the lessons among the slot counts, and parts of one in their whole numbers.
TAUGHT, LESSON = -1, 1 << 16
DEPTH_GATE = np.minimum(np.arange(HEAD), 11) // 3 * 4


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift, multiply)."""
    h = (h ^ (h >> W(33))) * W(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> W(33))) * W(0xC4CEB9FE1A85EC53)
    return h ^ (h >> W(33))


@lru_cache(maxsize=1)
def powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of POWER and of its inverse, 2**bits of each."""
    one = np.ones(1, W)
    up = np.cumprod(np.concatenate([one, np.full((1 << bits) - 1, POWER, W)]))
    down = np.cumprod(np.concatenate([one, np.full((1 << bits) - 1, pow(POWER, -1, 1 << 64), W)]))
    return up, down


def run_hashes(x: np.ndarray, start: np.ndarray, end: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
    """A hash of x[start:end] (or of the values at those places) for each of the runs,
    which ascend and don't overlap."""
    out, k = np.empty(len(start), W), 0
    while k < len(start):  # 32,768 places at once, which stay in cache, more for one longer run
        to = max(k + 1, int(np.searchsorted(start, start[k] + (1 << 15))))
        a, b = int(start[k]), int(end[to - 1])
        up, down = powers(max(21, (b - a).bit_length()))
        total = np.zeros(b - a + 1, W)
        np.cumsum((x[a:b] if values is None else values[x[a:b]]) * up[: b - a], out=total[1:])
        first = start[k:to] - a
        out[k:to] = (total.take(end[k:to] - a) - total.take(first)) * down.take(first)
        k = to
    return mixed(out + (end - start).astype(W) * W(0xD6E8FEB86659FD93))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.isin(np.arange(256), [SPACE, *range(9, 14)])


class Tokens:
    """The words of some texts end to end, each text's end after its words.

    hash, start and end (in ``data``, lower-cased), text_of and place (in its text)
    of each token; sizes: tokens of each text.
    """

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        """data: the bytes of all texts; ends: 0 and where each text ends."""
        self.data = _LOWER[data]
        inside = np.append(~_BLANK[data], False)
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        first[ends[:-1]] = inside[ends[:-1]]
        last[ends[1:] - 1] = inside[ends[1:] - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        at = np.searchsorted(start, ends)
        self.sizes = np.diff(at) + 1
        self.text_of = np.repeat(np.arange(len(self.sizes)), self.sizes)
        stop = np.cumsum(self.sizes) - 1
        self.place = (np.arange(len(self.text_of)) - (stop + 1 - self.sizes)[self.text_of])
        word = np.ones(len(self.text_of), bool)
        word[stop] = False
        self.hash, self.start, self.end = np.full(len(word), END, W), np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
        self.hash[word], self.start[word], self.end[word] = run_hashes(self.data, start, end, BYTE_HASH) & ~W(1), start, end

    @classmethod
    def of(cls, texts: list[str]) -> Tokens:
        data = [t.encode() for t in texts]
        return cls(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))

    def passages(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First token of each passage, its key and the key of its passing on from
        the one before it in the text.  Keys of words are even, these are odd."""
        pair = mixed(np.append(W(0), self.hash[:-1]) + W(3) * self.hash)
        cut = np.append(True, pair[:-1] % W(PASSAGE) == 0) & (self.place > 1) | (self.place == 0)
        start = np.flatnonzero(cut)
        key = run_hashes(self.hash, start, np.append(start[1:], len(self.hash))) | W(1)
        before = np.where(self.place[start] == 0, FIRST, np.append(W(0), key[:-1]))
        return start, key, mixed(before * W(5) + key) | W(1)


#: Keys of the end and of what is before a text's first passage.
END, FIRST = W(2), W(1)


def texts_of(column: pa.Array, size: int = 1 << 19) -> Iterator[tuple[slice, Tokens]]:
    """The tokens of runs of an Arrow column of texts (no nulls), about ``size`` bytes each."""
    column = column.cast(pa.large_string())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    k = 0
    while k < len(column):
        to = max(k + 1, int(np.searchsorted(ends, ends[k] + size)))
        to = min(to, len(column))
        yield slice(k, to), Tokens(data[ends[k] : ends[to]], ends[k : to + 1] - ends[k])
        k = to


def code_lengths(counts: np.ndarray) -> np.ndarray:
    """Huffman code lengths of symbols, by two queues over ascending counts."""
    n = len(counts)
    if n == 1:
        return np.zeros(1, np.int64)
    order = np.argsort(counts, kind="stable")
    leaf, inner, parent = counts[order].tolist(), [], np.zeros(2 * n - 1, np.int64)
    i = j = 0
    for node in range(n, 2 * n - 1):
        total = 0
        for _ in range(2):
            if j >= len(inner) or i < n and leaf[i] <= inner[j]:
                total, parent[i], i = total + leaf[i], node, i + 1
            else:
                total, parent[n + j], j = total + inner[j], node, j + 1
        inner.append(total)
    depth = np.zeros(2 * n - 1, np.int64)
    for node in range(2 * n - 3, n - 1, -1):
        depth[node] = depth[parent[node]] + 1
    out = np.empty(n, np.int64)
    out[order] = depth[parent[:n]] + 1
    return out


class Code:
    """A canonical Huffman code: length and bits of each symbol, of which the first
    HEAD are decisions; tail is the log of a symbol's share of what is below those."""

    def __init__(self, counts: np.ndarray):
        counts = np.maximum(counts, 1 + (int(counts.sum()) >> 30))
        length = code_lengths(counts)
        order = np.argsort(length, kind="stable")
        most = int(length.max())
        share = np.cumsum(np.append(0, np.ldexp(1.0, most - length[order])[:-1])).astype(np.int64)
        code = np.empty(len(length), np.int64)
        code[order] = share >> (most - length[order])
        self.length = np.minimum(length, HEAD)
        self.code = code >> (length - self.length)
        # With a one before its first bit a code, cut anywhere, is the number of a node.
        self.turned, self.aligned = (HEAD - self.length).astype(np.int8), (self.code << (HEAD - self.length) | 1 << HEAD).astype(U)
        _, at = np.unique(self.code << 8 | self.length, return_inverse=True)
        self.tail = np.log(counts / np.bincount(at, counts)[at])

    def sorted(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """The order of a run of symbols by falling length, their codes in that order, and
        of each depth how many are so long."""
        turned = self.turned.take(symbols)
        order = np.argsort(turned, kind="stable")
        longer = np.cumsum(np.bincount(turned, minlength=HEAD + 1))[HEAD - 1 :: -1]
        return order, self.aligned.take(symbols.take(order)), longer[longer > 0].tolist()

    def levels(self, symbols: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """The order of a run of symbols by falling length, and of each depth the nodes
        and bits of those that are so long, the first in that order."""
        order, code, longer = self.sorted(symbols)
        return order, [(code[:m] >> U(HEAD - d), code[:m] >> U(HEAD - 1 - d) & U(1)) for d, m in enumerate(longer)]

    def nodes(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """node, zeros and ones under each node, given the symbols' counts."""
        out = []
        for depth in range(int(self.length.max())):
            deep = np.flatnonzero(self.length > depth)
            code = self.code[deep] >> (self.length[deep] - depth - 1)
            node, at = np.unique(code >> 1 | np.int64(1) << depth, return_inverse=True)
            out.append((node.astype(U), *(np.bincount(at, np.where(code & 1 == b, counts[deep], 0), len(node)) for b in (0, 1))))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, U), np.zeros(0), np.zeros(0))


class Coder:
    """The frequent keys with their counts, and the codes of words and bytes."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, in_tree: np.ndarray, escapes: int, byte_counts: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]
        tree = np.flatnonzero(in_tree[order])
        self.escape, self.shift = len(tree), 64 - max(1, len(keys).bit_length())
        self.symbol = np.full(len(keys), self.escape, np.int32)
        self.symbol[tree] = np.arange(len(tree))
        counts = np.append(self.counts[tree], max(1, escapes))
        #: Rank by count of each symbol; the escape has none.
        self.rank = np.append(np.argsort(np.argsort(-counts[:-1], kind="stable")), 1 << 30).astype(np.int32)
        self.words, self.bytes = Code(counts), Code(byte_counts)
        self.nodes = self.words.nodes(counts)
        self.first = np.searchsorted(self.keys >> W(self.shift), np.arange((1 << 64 - self.shift) + 1, dtype=W)).astype(np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Places of hashes among the frequent keys, -1 for others."""
        b = (h >> W(self.shift)).astype(np.int64)
        at, last, out = self.first.take(b), self.first.take(b + 1), np.full(len(h), -1)
        live = np.flatnonzero(at < last)
        while len(live):
            place = at.take(live)
            same = self.keys.take(place) == h.take(live)
            out[live[same]] = place[same]
            live = live[~same]
            at[live] += 1
            live = live[at.take(live) < last.take(live)]
        return out


def mix(x: np.ndarray, y) -> np.ndarray:
    x = x ^ (np.atleast_1d(y) * U(0x9E3779B1))
    x = (x ^ (x >> U(15))) * U(0x85EBCA77)
    return x ^ (x >> U(13))


def before(x: np.ndarray, k: int, place: np.ndarray) -> np.ndarray:
    """The value k places before within its text or word, 0 at its start."""
    out = np.zeros(len(x), U)
    out[k:] = x[:-k] if k < len(x) else x[:0]
    out[place < k] = 0
    return out


def word_contexts(h: np.ndarray, rank: np.ndarray, place: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Contexts of each word, and its last common word before (0: none yet).  Of a
    word before that is not among the KNOWN_BEFORE commonest only seven bits count."""
    short = (h >> W(32)).astype(U)
    at = np.arange(len(h), dtype=np.int32)
    last = np.maximum.accumulate(np.where(rank < COMMON, at, -1))
    last = np.append(np.int32(-1), last[:-1])
    common = np.where(last >= at - place, rank[last] + 1, 0).astype(U)
    one = before(np.where(rank < KNOWN_BEFORE, short | U(1), (short & U(0xFE)) + U(2)), 1, place)
    return [np.full(len(h), ROOT), mix(common, U(3)), mix(one, U(5))], common


ROOT = U(0x1234567)


def byte_contexts(b: np.ndarray, place: np.ndarray, common: np.ndarray) -> list[np.ndarray]:
    """b: bytes + 1 of words end to end; place: where in its word each stands;
    common: the last common word before its word."""
    up, down = powers(max(21, len(b).bit_length()))
    total = np.cumsum(b.astype(W) * up[: len(b)])
    first = np.arange(len(b)) - place
    so_far = (total - b * up[: len(b)] - (total - b * up[: len(b)])[first]) * down[first]
    near = before(b, 1, place) + before(b, 2, place) * U(512)
    far = before(b, 3, place) + before(b, 4, place) * U(512)
    return [mix((so_far >> W(32)).astype(U) ^ so_far.astype(U), U(7)), mix(near, common + U(11)), mix(mix(near, U(13)), far)]


def slots(context: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    x = context ^ node * U(0x9E3779B1)
    x ^= x >> U(16)
    x *= U(0x85EBCA6B)
    x >>= U(32 - bits)
    return x


class Batch:
    """What some texts' decisions need: contexts of words, and of bytes of escaped words."""

    def __init__(self, tokens: Tokens, coder: Coder, coded: np.ndarray | None = None, found: np.ndarray | None = None):
        """coded: which tokens are coded as words (default: all); found: what the coder finds of all."""
        self.tokens, self.found = tokens, coder.find(tokens.hash) if found is None else found
        self.symbol = np.where(self.found >= 0, coder.symbol.take(self.found) if len(coder.symbol) else 0, coder.escape)
        self.contexts, common = word_contexts(tokens.hash, coder.rank.take(self.symbol), tokens.place)
        self.words = np.arange(len(tokens.hash)) if coded is None else np.flatnonzero(coded)
        out = self.words[self.symbol[self.words] == coder.escape]
        n = tokens.end[out] - tokens.start[out] + 1
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        self.byte_of, self.byte_place = np.repeat(out, n), place
        self.bytes = np.full(len(place), SPACE, np.int64)
        inner = place < np.repeat(n - 1, n)
        self.bytes[inner] = tokens.data.take((tokens.start.take(self.byte_of) + place)[inner])
        self.byte_contexts = byte_contexts(self.bytes.astype(U) + U(1), place, common.take(self.byte_of))


def tallied(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and how often each occurs."""
    keys = np.sort(keys)
    at = np.flatnonzero(np.append(np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]))
    return keys[at], np.diff(at, append=len(keys))


def log_odds(zeros, ones) -> np.ndarray:
    return np.clip(np.rint(QUANT * np.log((ones + PRIOR) / (zeros + PRIOR))), -127, 127).astype(np.int8)


#: Log odds of zeros and ones below FEW, at 128 * zeros + ones.
FEW = 127
SMALL_ODDS = log_odds(*np.indices((FEW + 1, FEW + 1), np.float32).reshape(2, -1))


class Counts:
    """Zeros and ones of slots, over texts that are counted in runs: equal pairs of a
    context and a symbol are met first, so that a path is walked once for all of them."""

    def __init__(self, coder: Coder):
        self.coder, self.waiting, self.size = coder, [[] for _ in SLOT_BITS], 0
        self.tables = [np.zeros(2 << k, np.int32) for k in SLOT_BITS]

    def add(self, batch: Batch):
        """batch: all words of its texts."""
        for k in (1, 2):  # the words' counts fill the first table
            self.waiting[k].append(batch.contexts[k].astype(W) << W(32) | batch.symbol.astype(W))
        for k, context in enumerate(batch.byte_contexts, 3):
            self.waiting[k].append(context.astype(W) << W(32) | batch.bytes.astype(W))
        self.size += len(batch.symbol) + len(batch.bytes)

    def count(self):
        """Count what waits."""
        for k, pairs in enumerate(self.waiting):
            if pairs:
                pairs, n = tallied(np.concatenate(pairs))
                self.waiting[k].clear()
                for a in range(0, len(pairs), 1 << 16):
                    some, times = pairs[a : a + (1 << 16)], n[a : a + (1 << 16)].astype(np.int32)
                    order, levels = (self.coder.bytes if k > 2 else self.coder.words).levels((some & W(0xFFFFFFFF)).astype(np.int64))
                    context, times = (some >> W(32)).astype(U)[order], times[order]
                    for node, bit in levels:
                        at = slots(context[: len(node)], node, SLOT_BITS[k])
                        np.add.at(self.tables[k], (at << U(1) | bit).astype(np.int64), times[: len(node)])
        self.size = 0

    def show(self, tables: list[np.ndarray]):
        """Write the log odds of all slots."""
        for table, counts in zip(tables[1:], self.tables[1:]):
            for a in range(0, len(table), 1 << BLOCK_BITS):
                some = counts[2 * a : 2 * (a + (1 << BLOCK_BITS))]
                least = np.minimum(some, FEW)
                at = least[::2] << 7
                at += least[1::2]
                out = SMALL_ODDS.take(at)
                if least.max() == FEW:
                    many = np.flatnonzero((least == FEW).view(np.int16))
                    out[many] = log_odds(*some.reshape(-1, 2)[many].astype(np.float32).T)
                table[a : a + len(out)] = out


def counted(coder, corpus: Corpus | None = None):
    """Task function: packed slot counts (salt, key, data) over the task's texts.  With
    ``corpus``, each run of texts is first priced by the slots of the task's texts before it,
    which teaches the weights: key TAUGHT has what they came to."""

    def run(batches):
        c = coder.value
        counts, tables, mixer, most, done = Counts(c), empty_tables(c), Mixer(first_weights(), 1), 1 << 17, 0
        for b in batches:
            for some, tokens in texts_of(b.column(0), 1 << 18):
                batch = Batch(tokens, c)
                if corpus is not None:
                    passages = Passages(tokens, c, np.ones(len(tokens.sizes), bool))
                    teach_batch(tokens, Decided(tokens, passages, Answers(b.column(1), some), corpus), batch, c, tables, mixer)
                counts.add(batch)
                # Slots are shown to later texts each time that they have doubled.
                if counts.size >= most:
                    done += counts.size
                    counts.count()
                    most = min(max(most, done), 1 << 21)
                    if corpus is not None:
                        counts.show(tables)
        counts.count()
        packer, part = zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId()

        def packed(key: int, data: bytes):
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([key], pa.int64()), pa.array([packer.compress(data)], pa.binary())], ["salt", "key", "data"])

        for k, table in enumerate(counts.tables):
            for j in range(0, len(table) // 2, 1 << BLOCK_BITS):
                data = table[2 * j : 2 * (j + (1 << BLOCK_BITS))]
                if data.any():
                    yield packed(k << 32 | j, np.ascontiguousarray(data.reshape(-1, 2).T, "<i4").tobytes())
        if corpus is not None:
            yield packed(TAUGHT, mixer.lesson().tobytes())

    return run


def summed(blocks: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """Sums packed counts of equal keys, streaming over a group's rows."""

    def run(key, batches):
        total, reader, packer = None, zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        for b in batches:
            for data in b.column(b.schema.get_field_index("data")).to_pylist():
                x = np.frombuffer(reader.decompress(data), "<i8" if key[0].as_py() == TAUGHT else kind).astype("<i8")
                total = x if total is None else total + x
        yield pa.RecordBatch.from_arrays([*(pa.array([k.as_py()], pa.int64()) for k in key), pa.array([packer.compress(total.tobytes())], pa.binary())], [*keys, "data"])

    run.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return blocks.groupBy(*keys).applyInArrow(run, ", ".join([*(f"{k} long" for k in keys), "data binary"]))


def quantised(batches):
    """Packed counts (zeros, ones) to packed log odds of a one, a byte each; lessons stay."""
    reader, packer = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
    for b in batches:
        out = []
        for key, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            out.append(x if key == TAUGHT else packer.compress(log_odds(*np.frombuffer(reader.decompress(x), "<i8").reshape(2, -1)).tobytes()))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["key", "data"])


def empty_tables(coder: Coder) -> list[np.ndarray]:
    """Tables without counts but those of the context-free one."""
    tables = [np.zeros(1 << k, np.int8) for k in SLOT_BITS]
    nodes, zeros, ones = coder.nodes
    tables[0][slots(np.full(len(nodes), ROOT), nodes, SLOT_BITS[0])] = log_odds(zeros, ones)
    return tables


def first_weights() -> tuple[np.ndarray, np.ndarray]:
    """Weights (3 by gate) and offsets before anything is learned."""
    w = np.repeat(np.array([[0.3], [0.5], [0.3]], np.float32), GATES, 1)
    w[:, FOLLOWS:] = 0
    w[0, KNOWN:] = -4
    return w, np.zeros(OFFSETS, np.float32)


class Mixer:
    """Weights and offsets of texts, the log probabilities so far, and what has taught them."""

    def __init__(self, start: tuple[np.ndarray, np.ndarray], texts: int):
        w, offsets = start
        self.w, self.offsets = [np.tile(x / np.float32(QUANT), texts) for x in w], np.tile(offsets, texts)
        self.cost, self.seen, self.refined = np.zeros(texts), np.zeros(texts * GATES), np.zeros(texts * OFFSETS)

    def lesson(self) -> np.ndarray:
        """Of a mixer of one text: weights and offsets times what taught them, and that, in
        whole numbers, whose sums don't depend on an order."""
        w = [np.rint(w.astype(float) * QUANT * self.seen * LESSON) for w in self.w]
        return np.concatenate([*w, self.seen, np.rint(self.offsets.astype(float) * self.refined * LESSON), self.refined]).astype("<i8")

    def code(self, own: np.ndarray | None, gate: np.ndarray, inputs: list[np.ndarray], bit: np.ndarray, kind: int) -> np.ndarray | None:
        """Code decisions with the weights as they are, then learn from all of them; each
        text's cost, but where there is but one text (None).  own: text * GATES + 16 * kind
        of each decision; gate: its place in w; inputs: log odds times QUANT."""
        z = self.w[0].take(gate)
        z *= inputs[0]
        for w, x in zip(self.w[1:], inputs[1:]):
            part = w.take(gate)
            part *= x
            z += part
        at = z + np.float32(8)
        np.clip(at, np.float32(0), np.float32(15), out=at)
        step = at.astype(np.int64)
        step += 16 * kind if own is None else own
        z += self.offsets.take(step)
        sign = bit.astype(np.float32)
        sign *= -2
        sign += 1
        z *= sign
        np.clip(z, np.float32(-20), np.float32(20), out=z)
        e = np.exp(z, out=z)
        more = e + np.float32(1)
        e *= sign
        pull = np.divide(e, more, out=e)
        np.negative(pull, out=pull)
        cost, lanes = None, LANES
        if own is not None:
            cost, lanes = np.bincount(own, np.log(more, out=more), len(self.seen))[16 * kind :: GATES], 1
        gates, steps = Bins(gate, len(self.seen), lanes), Bins(step, len(self.refined), lanes)
        self.seen += gates.n
        rate = RATE / QUANT**2 / (gates.n + STEADY)
        for w, x in zip(self.w, inputs):
            w += (gates.sums(pull * x) * rate).astype(np.float32)
        self.refined += steps.n
        self.offsets += (steps.sums(pull) * (OFFSET_RATE / (steps.n + STEADY))).astype(np.float32)
        return cost


class Bins:
    """Sums by bin.  Where all values meet in a few bins each waits for the sum before
    it; with lanes, neighbours are added to different sums of their bin."""

    def __init__(self, at: np.ndarray, size: int, lanes: int):
        self.at, self.size, self.lanes = at, size, lanes
        if lanes > 1:
            self.at = at * lanes
            self.at += np.arange(len(at)) % lanes
        self.n = self.sums(None)

    def sums(self, x: np.ndarray | None) -> np.ndarray:
        out = np.bincount(self.at, x, self.size * self.lanes)
        return out if self.lanes == 1 else out.reshape(-1, self.lanes).sum(1)


def step_of(place: np.ndarray) -> np.ndarray:
    """Weights are held for 16 words at a text's start, for 32 from 64, 128 from 256 and 256 from 1024 words on."""
    return np.where(place < 64, place // 16, np.where(place < 256, 2 + place // 32, np.where(place < 1024, 8 + place // 128, 12 + place // 256)))


class Answers:
    """Counts of rare keys, joined to the texts that asked for them."""

    def __init__(self, column: pa.ListArray | None = None, some: slice = slice(0, 0)):
        self.key, self.n = np.zeros(0, W), np.zeros(0, np.int64)
        if column is not None:
            column = column[some]
            sizes = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            flat = column.flatten()
            key = self.own(flat.field("key").to_numpy().view(W), np.repeat(np.arange(len(sizes)), sizes))
            order = np.argsort(key)
            self.key, self.n = key[order], flat.field("n").to_numpy()[order]

    @staticmethod
    def own(key: np.ndarray, text: np.ndarray) -> np.ndarray:
        return mixed(key + text.astype(W) * W(POWER))

    def of(self, key: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Counts of keys that texts (by their places in the slice) asked for; 0 where there is no answer."""
        if not len(self.key):
            return np.zeros(len(key), np.int64)
        want = self.own(key, text)
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where(self.key[at] == want, self.n[at], 0)


class Passages:
    """The passages of some texts with what other training texts hold of them."""

    def __init__(self, tokens: Tokens, coder: Coder, own: np.ndarray):
        """own: which texts are training texts."""
        self.start, key, pair = tokens.passages()
        self.text, self.own = tokens.text_of[self.start], own
        # A text's distinct keys in order, with how often they occur in it.
        both, text = np.concatenate([key, pair]), np.concatenate([self.text, self.text])
        order = np.lexsort((both, text))
        both_, text_ = both[order], text[order]
        new = np.append(True, (both_[1:] != both_[:-1]) | (text_[1:] != text_[:-1]))
        self.key, self.of_text = both_[new], text_[new]
        self.times = np.diff(np.flatnonzero(np.append(new, True)))
        self.at = np.empty(len(both), np.int64)
        self.at[order] = np.cumsum(new) - 1
        found = coder.find(self.key)
        self.rare = found < 0
        self.n = np.where(self.rare, 0, coder.counts[found] if len(coder.counts) else 0)

    def others(self, answers: Answers, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How often each passage, its passing on, and what is before it stand in
        other training texts, of which there are ``texts`` with the text itself."""
        n = self.n.copy()
        n[self.rare] = answers.of(self.key[self.rare], self.of_text[self.rare])
        n = np.maximum(n - np.where(self.own[self.of_text], self.times, 0), 0)[self.at]
        key, pair = n[: len(self.start)], n[len(self.start) :]
        first = np.append(True, self.text[1:] != self.text[:-1])
        return key, pair, np.where(first, texts - self.own[self.text], np.append(0, key[:-1]))


class Corpus(NamedTuple):
    """What the training texts come to: words, distinct words, texts and passages."""

    words: int
    distinct: int
    texts: int
    passages: int


class Decided:
    """Of each passage: how often it (key), its passing on (pair) and what is before it
    (context) stand in other training texts, and so what is decided of it."""

    def __init__(self, tokens: Tokens, passages: Passages, answers: Answers, corpus: Corpus):
        self.key, self.pair, self.context = passages.others(answers, corpus.texts)
        self.follows, self.known = self.pair > 0, self.key > 0
        self.held = self.follows | self.known
        #: Tokens that are coded as words.
        self.coded = np.repeat(~self.held, np.diff(passages.start, append=len(tokens.hash)))
        self.was = np.append(False, self.held[:-1]) & (tokens.place[passages.start] > 0)

    def decisions(self, some: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]]:
        """Passages, gates, inputs and bits of both kinds of decisions on some passages."""
        may = some[self.context[some] > 0]
        rest = some[~self.follows[some]]
        for which, gate, n, bit in (
            (may, FOLLOWS + 2 * np.minimum(np.log2(self.context[may]), 3).astype(int) + self.was[may], self.context[may], self.follows[may]),
            (rest, KNOWN + 2 * (self.context[rest] > 0) + self.was[rest], np.zeros(len(rest)), self.known[rest]),
        ):
            if len(which):
                yield which, gate, [np.full(len(which), QUANT, np.float32), (QUANT * np.log(n + 1)).astype(np.float32)], bit


def known_gates(rows: list[np.ndarray]) -> np.ndarray:
    """Parts of gates: which of two contexts have counts."""
    gate = (rows[1] != 0).view(np.int8) * np.int8(2)
    gate += rows[2] != 0
    return gate


def roots(tables: list[np.ndarray]) -> np.ndarray:
    """Log odds without context of each node."""
    return tables[0][slots(ROOT, np.arange(1 << HEAD, dtype=U), SLOT_BITS[0])]


def teach_batch(tokens: Tokens, decided: Decided, batch: Batch, coder: Coder, tables: list[np.ndarray], mixer: Mixer):
    """Weights of one mixer learn from what score_batch codes of some texts, a depth of
    all paths at a time.  batch: all words."""
    for _, gate, x, bit in decided.decisions(np.arange(len(decided.key))):
        mixer.code(None, gate, x, bit, 2)
    root, escaped = roots(tables), decided.coded[batch.byte_of]
    for first, code, symbols, contexts, some in (
        (0, coder.words, batch.symbol, batch.contexts, np.flatnonzero(decided.coded)),
        (3, coder.bytes, batch.bytes, batch.byte_contexts, np.flatnonzero(escaped)),
    ):
        order, levels = code.levels(symbols[some])
        some = some[order]
        held = [c.take(some) for c in contexts]
        for d, (node, bit) in enumerate(levels):
            rows = [tables[k].take(slots(c[: len(node)], node, SLOT_BITS[k])) if k else root.take(node) for k, c in enumerate(held, first)]
            gate = known_gates(rows).astype(np.int64)
            gate += DEPTH_GATE[d] + (BYTES if first else WORDS)
            mixer.code(None, gate, [x.astype(np.float32) for x in rows], bit, first // 3)


def score_batch(tokens: Tokens, passages: Passages, answers: Answers, corpus: Corpus, coder: Coder, tables: list[np.ndarray], mixer: Mixer, found: np.ndarray | None = None) -> np.ndarray:
    """Natural log probability of each text, which has weights of its own.  found: as in Batch."""
    out = np.zeros(len(tokens.sizes))
    step = step_of(tokens.place)
    decided = Decided(tokens, passages, answers, corpus)
    held, follows = decided.held, decided.follows
    # A known passage's share: after the one before it, else among all passages.
    share = np.where(follows, decided.pair / np.maximum(decided.context, 1), decided.key / max(1, corpus.passages))[held]
    out -= np.bincount(passages.text[held], np.log(np.minimum(share, 1)), len(out))
    p_step = step[passages.start]
    order = np.argsort(p_step, kind="stable")
    p_bounds = np.searchsorted(p_step[order], np.arange(step.max() + 2))
    batch = Batch(tokens, coder, decided.coded, found)
    out -= np.bincount(tokens.text_of[batch.words], coder.words.tail[batch.symbol[batch.words]], len(out))
    out -= np.bincount(tokens.text_of[batch.byte_of], coder.bytes.tail[batch.bytes], len(out))
    # Of a step the first words of all texts, then the second and so on, so that neighbours are of
    # different texts and are added to different bins; of its spelled words the first bytes and so on.
    order_w = np.argsort(tokens.place[batch.words], kind="stable")
    bounds = np.searchsorted(step[batch.words[order_w]], np.arange(step.max() + 2))
    byte_steps = step[batch.byte_of] << 32 | batch.byte_place
    order_b = np.argsort(byte_steps, kind="stable")
    # Bytes of a word beyond 4,096 learn from those before them, so a step of them stays small.
    byte_steps = byte_steps[order_b] >> 12
    byte_starts = np.flatnonzero(np.diff(byte_steps, prepend=-1))
    byte_ends, byte_step = np.append(byte_starts[1:], len(order_b)), byte_steps[byte_starts] >> 20
    byte_first = np.searchsorted(byte_step, np.arange(step.max() + 2))

    def path(first: int, code: Code, some: np.ndarray, token: np.ndarray, symbols: np.ndarray, contexts: list[np.ndarray]):
        if not len(some):
            return
        order, codes, longer = code.sorted(symbols.take(some))
        if not longer:  # a tree of one symbol
            return
        some = some.take(order)
        own = tokens.text_of.take(token.take(some))
        own *= GATES
        own += BYTES if first else WORDS
        # The decisions of all depths end to end.
        node = np.concatenate([codes[:m] >> U(HEAD - 1 - d) for d, m in enumerate(longer)])
        bit = node & U(1)
        node >>= U(1)
        rows = []
        for k, c in enumerate(contexts, first):
            if k:
                c = c.take(some)
                rows.append(tables[k].take(slots(np.concatenate([c[:m] for m in longer]), node, SLOT_BITS[k])))
            else:
                rows.append(root.take(node))
        gate = np.concatenate([own[:m] + DEPTH_GATE[d] for d, m in enumerate(longer)])
        gate += known_gates(rows)
        own = np.concatenate([own[:m] for m in longer])
        np.add(out, mixer.code(own, gate, [x.astype(np.float32) for x in rows], bit, first // 3), out=out)

    contexts, root = batch.contexts, roots(tables)
    for k in range(int(step.max()) + 1):
        some = order[p_bounds[k] : p_bounds[k + 1]]
        for some, gate, x, bit in decided.decisions(some):
            own = passages.text[some] * GATES
            np.add(out, mixer.code(own + FOLLOWS, own + gate, x, bit, 2), out=out)
        path(0, coder.words, batch.words[order_w[bounds[k] : bounds[k + 1]]], np.arange(len(step)), batch.symbol, contexts)
        for j in range(byte_first[k], byte_first[k + 1]):
            path(3, coder.bytes, order_b[byte_starts[j] : byte_ends[j]], batch.byte_of, batch.bytes, batch.byte_contexts)
    return -out


def gathered(batches):
    """key and number of the words, passages and passings of a task's texts; repeats
    meet within a few million."""
    held: list[np.ndarray] = []

    def flush():
        keys, n = tallied(np.concatenate(held or [np.zeros(0, W)]))
        held.clear()
        for a in range(0, len(keys), 1 << 17):
            yield pa.RecordBatch.from_arrays([pa.array(keys[a : a + (1 << 17)].view(np.int64)), pa.array(n[a : a + (1 << 17)])], ["key", "n"])

    for b in batches:
        for _, tokens in texts_of(b.column(0)):
            held += [tokens.hash, *tokens.passages()[1:]]
            if sum(map(len, held)) > 1 << 22:
                yield from flush()
    yield from flush()


def frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, Column]:
    """The ``most`` commonest keys and their counts, and which rows of ``counts``
    they are.  Of the last count that has a place, keys are taken by the first 16
    bits while they fit."""
    classes = counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).limit(most + 1).toArrow()
    held = np.cumsum(classes.column("words").to_numpy())
    whole = int(np.searchsorted(held, most, "right"))
    chosen = F.lit(True)
    if whole < len(held):
        last, room = classes.column("n")[whole].as_py(), most - (int(held[whole - 1]) if whole else 0)
        bits = F.shiftright("key", 48)
        dealt = counts.where(F.col("n") == last).groupBy(bits.alias("bits")).agg(F.count("*").alias("words")).orderBy("bits").toArrow()
        fit = int(np.searchsorted(np.cumsum(dealt.column("words").to_numpy()), room, "right"))
        chosen = (F.col("n") > last) | (F.col("n") == last) & (bits < dealt.column("bits")[fit].as_py())
    top = counts.where(chosen).toArrow()
    return top.column("key").to_numpy(), top.column("n").to_numpy(), chosen


def coder_of(keys: np.ndarray, n: np.ndarray, words: int, tree_words: int, least_count: int) -> Coder:
    """The coder of the frequent keys; ``words``: all training words."""
    tree = np.flatnonzero((keys & 1 == 0) & (n >= least_count))
    tree = tree[np.lexsort((keys[tree], -n[tree]))][:tree_words]
    in_tree = np.zeros(len(keys), bool)
    in_tree[tree] = True
    # Common letters weigh more than other bytes; the tree's shape changes cost, not the sum over outcomes.
    shape = np.where(np.arange(256) >= 128, 20, 2)
    shape[np.frombuffer(b"eanitrsoldhcumgpfbvwkzyxqj", np.uint8)] = 3000 // np.arange(4, 30)
    shape[SPACE] = 600
    return Coder(keys.view(W), n, in_tree, words - int(n[tree].sum()), shape)


def asked(coder):
    """Task function: uid, key and m of the keys of texts that are not frequent; m: how
    often the text itself has put a passage into the counts."""

    def run(batches):
        c = coder.value
        for b in batches:
            uid, own = b.column(0).to_numpy(), ~b.column(2).to_numpy(zero_copy_only=False)
            for some, tokens in texts_of(b.column(1)):
                p = Passages(tokens, c, own[some])
                new = c.find(tokens.hash) < 0
                words = np.stack([tokens.text_of[new].astype(W), tokens.hash[new]], 1)
                words = words[np.lexsort((words[:, 1], words[:, 0]))]
                words = words[np.append(True, (words[1:] != words[:-1]).any(1))[: len(words)]]
                text = np.concatenate([words[:, 0].astype(np.int64), p.of_text[p.rare]])
                key = np.concatenate([words[:, 1], p.key[p.rare]])
                m = np.concatenate([np.zeros(len(words), np.int64), np.where(own[some][p.of_text], p.times, 0)[p.rare]])
                yield pa.RecordBatch.from_arrays([pa.array(uid[some][text]), pa.array(key.view(np.int64)), pa.array(m)], ["uid", "key", "m"])

    return run


def averaged(lesson: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and offsets from the sum of all lessons: each task's by how many decisions taught it."""
    w, seen, offsets, refined = np.split(lesson / 1.0, [3 * GATES, 4 * GATES, 4 * GATES + OFFSETS])
    start = first_weights()[0]
    return np.where(seen > 0, w.reshape(3, GATES) / LESSON / np.maximum(seen, 1), start).astype(np.float32), (offsets / LESSON / np.maximum(refined, 1)).astype(np.float32)


def scored(coder, model, corpus: Corpus, start: tuple[np.ndarray, np.ndarray]):
    """Task function: doc_id, held_out, n_tokens, n_known, base_score, score, bits_per_byte."""
    spread = corpus.words + corpus.distinct + 1

    def run(batches):
        c = coder.value
        for b in batches:
            own = ~b.column(2).to_numpy(zero_copy_only=False)
            for some, tokens in texts_of(b.column(1), 1 << 20):
                answers, texts = Answers(b.column(3), some), len(tokens.sizes)
                found = c.find(tokens.hash)
                logp = score_batch(tokens, Passages(tokens, c, own[some]), answers, corpus, c, model.value, Mixer(start, texts), found)
                n = np.where(found < 0, 0, c.counts[found] if len(c.counts) else 0)
                n[found < 0] = answers.of(tokens.hash[found < 0], tokens.text_of[found < 0])
                base = np.bincount(tokens.text_of, np.log10((n + 1) / spread), texts)
                known = np.bincount(tokens.text_of[n > 0], minlength=texts)
                size = pa.compute.binary_length(b.column(1)[some].cast(pa.large_binary())).to_numpy() + 1
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[some], b.column(2)[some], pa.array(tokens.sizes), pa.array(known), pa.array(base), pa.array(logp / math.log(10)), pa.array(-logp / math.log(2) / size)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "bits_per_byte"],
                )

    return run


def score_texts(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", tree_words: int = TREE_WORDS, frequent_keys: int = FREQUENT, least_count: int = LEAST_COUNT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and
    bits_per_byte for every row of ``docs``.

    Rows that ``held_out`` marks (null counts as false) are scored but not
    learned from.  A null or empty text is its end alone.  base_score is the
    add-one unigram log10 probability of the tokens; score is that of the mixing
    model.  A training text's own passages don't foretell it, those of other
    texts do; the slots and word counts hold every training text.  Unknown words
    are spelled, so every text has a probability.  Keys are 64-bit hashes.  Equal
    texts with equal marks get equal scores; repeated rows stay; without training
    rows every count is 0.  A table without rows gives none.  Other columns are
    ignored.

    Every training text is counted in the slots and teaches the weights, in one pass:
    a task prices a text by the slots of those it has met before, learns from it and
    counts it.  Slots of all tasks are summed, weights averaged by how many decisions
    taught them, so weights depend a little on how rows are dealt to tasks.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    train = rows.where(~F.col("held_out")).select("text")
    counts = stored(train.mapInArrow(gathered, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "lm-counts")
    word = F.col("key") % 2 == 0
    total = lambda x, c: F.coalesce(F.sum(F.when(c, x)), F.lit(0))
    sums = counts.agg(total(F.col("n"), word), total(F.lit(1), word), total(F.col("n"), F.col("key") == int(END)), total(F.col("n"), ~word)).first()
    corpus = Corpus(sums[0], sums[1], sums[2], sums[3] // 2)

    keys, n, chosen = frequent(counts, frequent_keys)
    coder = spark.sparkContext.broadcast(coder_of(keys, n, corpus.words, tree_words, least_count))
    uid = F.xxhash64("doc_id", "text", "held_out").alias("uid")
    wanted = rows.select(uid, "text", "held_out").mapInArrow(asked(coder), "uid long, key long, m long")
    # Whatever is hot is frequent, so no key of this join is; repeated rows ask twice for the same.
    met = wanted.join(counts.where(~chosen), "key").where("n > m")
    known = stored(met.groupBy("uid").agg(F.collect_set(F.struct("key", "n")).alias("known")), "lm-known")
    asking = rows.select(uid, "*").join(known, "uid", "left")

    tables, lesson = empty_tables(coder.value), np.zeros(4 * GATES + 2 * OFFSETS, np.int64)
    shards = max(1, math.isqrt(train.rdd.getNumPartitions()))
    lessons = asking.where(~F.col("held_out")).select("text", "known")
    blocks = lessons.mapInArrow(counted(coder, corpus), "salt long, key long, data binary").withColumn("salt", F.col("salt") % shards)
    packed = summed(summed(blocks, ["key", "salt"], "<i4").select("key", "data"), ["key"], "<i8").mapInArrow(quantised, "key long, data binary")
    reader = zstandard.ZstdDecompressor()
    for r in packed.toLocalIterator():
        data = reader.decompress(r["data"])
        if r["key"] == TAUGHT:
            lesson = np.frombuffer(data, "<i8")
        else:
            at = r["key"] & 0xFFFFFFFF
            tables[r["key"] >> 32][at : at + len(data)] = np.frombuffer(data, np.int8)
    model, start = spark.sparkContext.broadcast(tables), averaged(lesson)

    out = asking.select("doc_id", "text", "held_out", "known").mapInArrow(scored(coder, model, corpus, start), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, bits_per_byte double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(corpus.words).cast("long").alias("train_tokens"), "base_score", "score", "bits_per_byte")

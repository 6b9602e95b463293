"""The language model against a plain version that codes one decision after the other."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spanloom.llm import lm_score as lm
from spanloom.llm import queries

MASK, U32 = (1 << 64) - 1, 0xFFFFFFFF
TEXTS = ["The cat\tsat on the mat", "the dog sat", "", "a zebra é É \x0b\x0cx", "the the the", "  \n ", "x" * 300, "one two three four five six seven eight nine ten"]


def table(spark, rows):
    return spark.createDataFrame([(k, t, -1, "x") for k, t in rows], "doc_id long, text string, n_tokens int, score string").repartition(3)


def split(text):
    return [*text.encode().lower().split(), b""]


def finished(h):
    h = ((h ^ h >> 33) * 0xFF51AFD7ED558CCD) & MASK
    h = ((h ^ h >> 33) * 0xC4CEB9FE1A85EC53) & MASK
    return h ^ h >> 33


def run_hash(x):
    return finished((sum(v * pow(lm.POWER, k, 1 << 64) for k, v in enumerate(x)) + len(x) * 0xD6E8FEB86659FD93) & MASK)


def word_hash(w):
    return run_hash([int(lm.BYTE_HASH[c]) for c in w]) & ~1 if w else int(lm.END)


def plain_passages(text):
    """(first word, key, key of its passing on) of each passage."""
    h = [word_hash(w) for w in split(text)]
    cuts = [0, *(k for k in range(2, len(h)) if finished((h[k - 2] + 3 * h[k - 1]) & MASK) % lm.PASSAGE == 0)]
    out, before = [], int(lm.FIRST)
    for a, b in zip(cuts, [*cuts[1:], len(h)]):
        key = run_hash(h[a:b]) | 1
        out.append((a, key, finished((before * 5 + key) & MASK) | 1))
        before = key
    return out


def random_texts(seed, n=60):
    pick = random.Random(seed)
    words = [f"w{k}" for k in range(40)] + ["the", "of", "Ünder", "it,"]
    out = [" ".join(pick.choices(words, k=pick.choice([0, 1, 5, 20, 90, 400]))) for _ in range(n)]
    for k in range(0, n, 4):
        out[k] += " " + out[(k * 7 + 1) % n]
    return out + TEXTS


def test_words_are_those_of_a_plain_split():
    tokens = lm.Tokens.of(TEXTS)
    assert tokens.hash.tolist() == [word_hash(w) for t in TEXTS for w in split(t)]
    assert tokens.sizes.tolist() == [len(split(t)) for t in TEXTS]
    assert [bytes(tokens.data[a:b]) for a, b in zip(tokens.start, tokens.end)] == [w for t in TEXTS for w in split(t)]
    column = pa.array(["x", *TEXTS, "y"])[1:-1]
    got = [(some.start, t.hash.tolist()) for some, t in lm.texts_of(column, 20)]
    assert sum((h for _, h in got), []) == tokens.hash.tolist() and len(got) > 3
    assert list(lm.texts_of(column[:0])) == []
    for t in random_texts(3):
        start, key, pair = lm.Tokens.of([t]).passages()
        assert list(zip(start.tolist(), key.tolist(), pair.tolist())) == plain_passages(t)


def test_codes_are_prefix_free_and_as_short_as_any():
    for counts in ([5], [1, 1], [9, 4, 3, 1, 1, 1], list(range(1, 200)), [2**k for k in range(20)]):
        code = lm.Code(np.array(counts))
        words = [format(int(c), f"0{n}b") if n else "" for c, n in zip(code.code, code.length)]
        assert not any(a != b and b.startswith(a) for k, a in enumerate(words) for b in words[:k] + words[k + 1 :])
        total, heap = 0, sorted(counts)
        while len(heap) > 1:
            both = heap[0] + heap[1]
            total, heap = total + both, sorted([*heap[2:], both])
        assert total == (np.array(counts) * lm.code_lengths(np.array(counts))).sum()
        below = defaultdict(int)
        for w, c in zip(words, counts):
            below[w] += c
        assert np.exp(code.tail) == pytest.approx([c / below[w] for w, c in zip(words, counts)])
        assert sum(2.0 ** -len(w) for w in below) == 1 and max(map(len, words)) <= lm.HEAD


class Plain:
    """One decision after the other: slot counts, and the price of a text."""

    def __init__(self, coder):
        self.coder, self.tree = coder, {int(coder.keys[k]): int(s) for k, s in enumerate(coder.symbol)}
        self.slots = defaultdict(lambda: [0, 0])

    def decisions(self, text, at=None):
        """(first table, word's place, context values, depth, node, bit) of the words at ``at``, then of the spelled ones."""
        words = split(text)
        h = [word_hash(w) for w in words]
        symbol = [self.tree.get(x, self.coder.escape) for x in h]
        rank = [int(self.coder.rank[s]) for s in symbol]
        spelled, common, last = [], 0, 0
        for k, w in enumerate(words):
            one = 0
            if k:
                short = h[k - 1] >> 32
                one = short | 1 if rank[k - 1] < lm.KNOWN_BEFORE else (short & 0xFE) + 2
            common = last
            if at is None or k in at:
                contexts = [int(lm.ROOT), self.mix(common, 3), self.mix(one, 5)]
                yield from self.path(0, k, contexts, self.coder.words, symbol[k])
                if symbol[k] == self.coder.escape:
                    spelled.append((k, w, common))
            if rank[k] < lm.COMMON:
                last = rank[k] + 1
        for k, w, common in spelled:
            b, so_far = [c + 1 for c in w], 0
            for j, c in enumerate([*w, 32]):
                so_far = (so_far + b[j - 1] * pow(lm.POWER, j - 1, 1 << 64)) & MASK if j else 0
                back = [0, *(b[j - i] if j >= i else 0 for i in range(1, 5))]
                near, far = back[1] + back[2] * 512, back[3] + back[4] * 512
                contexts = [self.mix(so_far >> 32 ^ so_far & U32, 7), self.mix(near, common + 11), self.mix(self.mix(near, 13), far)]
                yield from self.path(3, k, contexts, self.coder.bytes, c, j)

    def mix(self, x, y):
        x = x ^ y * 0x9E3779B1 & U32
        x = (x ^ x >> 15) * 0x85EBCA77 & U32
        return x ^ x >> 13

    def path(self, first, k, contexts, code, symbol, place=0):
        n, bits = int(code.length[symbol]), int(code.code[symbol])
        for d in range(n):
            yield first, k, contexts, d, bits >> n - d | 1 << d, bits >> n - d - 1 & 1, place

    def slot(self, table, context, node):
        x = context ^ node * 0x9E3779B1 & U32
        x = (x ^ x >> 16) * 0x85EBCA6B & U32
        return table, x >> 32 - lm.SLOT_BITS[table]

    def learn(self, text):
        for first, _, contexts, _, node, bit, _ in self.decisions(text):
            for j, c in enumerate(contexts, first):
                if j:
                    self.slots[self.slot(j, c, node)][bit] += 1

    def score(self, text, own, counts, corpus, tables, start):
        """Natural log probability; counts: of all keys over training texts, own: whether the text is one."""
        passages, n_words = plain_passages(text), len(split(text))
        times = Counter(x for p in passages for x in p[1:])
        other = lambda x: max(0, counts[x] - (times[x] if own else 0))
        w, offsets = [list(map(float, x)) for x in start[0]], list(map(float, start[1]))
        total, coded, asks, was, context = 0.0, set(), [], 0, corpus.texts - own
        for (a, key, pair), b in zip(passages, [*(p[0] for p in passages[1:]), n_words]):
            follows, known = other(pair) > 0, other(key) > 0
            if context:
                asks.append((self.step(a), 0, 0, lm.FOLLOWS + 2 * min(3, int(math.log2(context))) + was, [lm.QUANT, lm.QUANT * math.log(context + 1)], follows, 2))
            if not follows:
                asks.append((self.step(a), 1, 0, lm.KNOWN + 2 * (context > 0) + was, [lm.QUANT, 0], known, 2))
            if follows or known:
                total += math.log(min(1, other(pair) / context if follows else other(key) / corpus.passages))
            else:
                coded |= set(range(a, b))
            was, context = follows or known, other(key)
        for k in coded:
            symbol = self.tree.get(word_hash(split(text)[k]), self.coder.escape)
            total += self.coder.words.tail[symbol]
            if symbol == self.coder.escape:
                total += sum(self.coder.bytes.tail[c] for c in [*split(text)[k], 32])
        for first, k, contexts, d, node, bit, place in self.decisions(text, coded):
            x = [int(tables[j][self.slot(j, c, node)[1]]) for j, c in enumerate(contexts, first)]
            asks.append((self.step(k), 2 + first, place // 4096, (lm.BYTES if first else lm.WORDS) + min(d, 11) // 3 * 4 + (x[1] != 0) * 2 + (x[2] != 0), x, bit, first // 3))
        together = defaultdict(list)
        for ask in asks:
            together[ask[:3]].append(ask[3:])
        for _, some in sorted(together.items()):
            pulls, refined = defaultdict(list), defaultdict(list)
            for gate, x, bit, kind in some:
                z = sum(v[gate] * y / lm.QUANT for v, y in zip(w, x))
                bucket = 16 * kind + int(min(15, max(0, z + 8)))
                z += offsets[bucket]
                p = 1 / (1 + math.exp(-z))
                total += math.log(p if bit else 1 - p)
                pulls[gate].append([(bit - p) * y / lm.QUANT for y in x])
                refined[bucket].append(bit - p)
            for gate, pull in pulls.items():
                for v, g in zip(w, zip(*pull)):
                    v[gate] += lm.RATE * sum(g) / (len(pull) + lm.STEADY)
            for bucket, pull in refined.items():
                offsets[bucket] += lm.OFFSET_RATE * sum(pull) / (len(pull) + lm.STEADY)
        return total

    @staticmethod
    def step(place):
        return place // 16 if place < 64 else 2 + place // 32 if place < 256 else 8 + place // 128 if place < 1024 else 12 + place // 256


class Shared:
    def __init__(self, value):
        self.value = value


def test_slots_and_scores_are_those_of_one_decision_after_the_other(monkeypatch):
    texts = [*random_texts(5), "long " + "ab" * 2100 + " word"]
    own = np.arange(len(texts)) % 3 > 0
    train = [t for t, o in zip(texts, own) if o]
    counts = Counter(x for t in train for x in [word_hash(w) for w in split(t)] + [y for p in plain_passages(t) for y in p[1:]])
    words = {k: n for k, n in counts.items() if k % 2 == 0}
    corpus = lm.Corpus(sum(words.values()), len(words), len(train), sum(len(plain_passages(t)) for t in train))
    batch = pa.RecordBatch.from_arrays([pa.array(train)], ["text"])
    got = Counter()
    for b in lm.gathered([batch]):
        got.update(dict(zip(b.column(0).to_numpy().view(np.uint64).tolist(), b.column(1).to_pylist())))
    assert got == counts
    keys = np.array(sorted(counts), np.uint64)
    frequent = keys[::2]
    coder = lm.coder_of(frequent.view(np.int64), np.array([counts[int(k)] for k in frequent]), corpus.words, 12, 4)
    assert 2 < coder.escape <= 12

    plain = Plain(coder)
    for t in train:
        plain.learn(t)
    monkeypatch.setattr(lm, "TaskContext", type("Task", (), {"get": staticmethod(lambda: type("Id", (), {"partitionId": lambda self: 0})())}))
    tables, reader = lm.empty_tables(coder), lm.zstandard.ZstdDecompressor()
    for b in lm.counted(Shared(coder))([batch]):
        key, x = b["key"][0].as_py(), np.frombuffer(reader.decompress(b["data"][0].as_py()), "<i4").reshape(2, -1)
        at = key & U32
        for j in np.flatnonzero(x.any(0)).tolist():
            assert plain.slots.pop((key >> 32, at + j)) == x[:, j].tolist()
        tables[key >> 32][at : at + x.shape[1]] = lm.log_odds(*x)
    assert not plain.slots

    draw = np.random.default_rng(1)
    start = draw.normal(0.4, 0.2, (3, lm.GATES)).astype(np.float32), draw.normal(0, 0.3, lm.OFFSETS).astype(np.float32)
    tokens = lm.Tokens.of(texts)
    rare = pa.array([[{"key": int(np.uint64(k).view(np.int64)), "n": n} for k, n in counts.items() if k not in set(frequent.tolist())]] * len(texts), pa.list_(pa.struct([("key", pa.int64()), ("n", pa.int64())])))
    answers = lm.Answers(rare, slice(0, len(texts)))
    logp = lm.score_batch(tokens, lm.Passages(tokens, coder, own), answers, corpus, coder, tables, lm.Mixer(start, len(texts)))
    for t, o, found in zip(texts, own, logp):
        assert found == pytest.approx(plain.score(t, bool(o), counts, corpus, tables, start), rel=2e-4), t[:60]


def test_every_training_text_is_counted_and_teaches_the_weights(spark, monkeypatch):
    pick = random.Random(8)
    words = [f"w{k}" for k in range(30)]
    rows = [(k, " ".join([f"only{k}x", *pick.choices(words, k=pick.choice([3, 20, 90]))])) for k in range(120)]
    held, coders, lessons, tables = F.col("doc_id") % 4 == 1, [], [], []
    for name, seen in (("coder_of", coders), ("averaged", lessons), ("empty_tables", tables)):
        def kept(*args, run=getattr(lm, name), seen=seen):
            out = run(*args)
            seen.append(args[0] if run.__name__ == "averaged" else out)
            return out
        monkeypatch.setattr(lm, name, kept)
    assert lm.score_texts(table(spark, rows), held, least_count=2).count() == 120
    plain = Plain(coders[0])
    train = [t for k, t in rows if k % 4 != 1]
    for t in train:
        plain.learn(t)
    for (k, at), (zeros, ones) in plain.slots.items():
        assert tables[0][k][at] == lm.log_odds(np.array(zeros), np.array(ones))
    # All words are decided but those of passages that other texts hold.
    passages = Counter(p[1] for t in train for p in plain_passages(t))
    decisions = Counter()
    for t in train:
        p, mine = plain_passages(t), Counter(x[1] for x in plain_passages(t))
        ends = [*(x[0] for x in p[1:]), len(split(t))]
        at = {k for (start, key, _), end in zip(p, ends) if passages[key] == mine[key] for k in range(start, end)}
        assert 0 in at
        decisions.update(d[0] for d in plain.decisions(t, at))
    taught = lessons[0][3 * lm.GATES : 4 * lm.GATES]
    assert (taught[: lm.BYTES].sum(), taught[lm.BYTES : lm.FOLLOWS].sum()) == (decisions[0], decisions[3])


def test_teaching_moves_weights_by_the_gradient_of_each_depth():
    """One text, one gate a decision: weights after a lesson are those of plain steps."""
    coder = lm.Coder(np.array([word_hash(b"aa"), word_hash(b"bb")], np.uint64), np.array([9, 4]), np.ones(2, bool), 2, np.ones(256, int))
    tables = [np.random.default_rng(k).integers(-60, 60, 1 << b).astype(np.int8) for k, b in enumerate(lm.SLOT_BITS)]
    tokens, corpus, plain = lm.Tokens.of(["aa bb aa"]), lm.Corpus(4, 3, 0, 1), Plain(coder)
    mixer, batch = lm.Mixer(lm.first_weights(), 1), lm.Batch(tokens, coder)
    decided = lm.Decided(tokens, lm.Passages(tokens, coder, np.zeros(1, bool)), lm.Answers(), corpus)
    lm.teach_batch(tokens, decided, batch, coder, tables, mixer)
    w, offsets = [list(map(float, x)) for x in lm.first_weights()[0]], [0.0] * lm.OFFSETS
    together = defaultdict(list)
    for first, k, contexts, d, node, bit, _ in plain.decisions("aa bb aa"):
        x = [int(tables[j][plain.slot(j, c, node)[1]]) for j, c in enumerate(contexts, first)]
        together[first, d].append(((lm.BYTES if first else lm.WORDS) + min(d, 11) // 3 * 4 + (x[1] != 0) * 2 + (x[2] != 0), x, bit, first // 3))
    for _, some in sorted(together.items()):
        pulls, refined = defaultdict(list), defaultdict(list)
        for gate, x, bit, kind in some:
            z = sum(v[gate] * y / lm.QUANT for v, y in zip(w, x))
            bucket = 16 * kind + int(min(15, max(0, z + 8)))
            miss = bit - 1 / (1 + math.exp(-max(-20, min(20, z + offsets[bucket]))))
            pulls[gate].append([miss * y / lm.QUANT for y in x])
            refined[bucket].append(miss)
        for gate, pull in pulls.items():
            for v, g in zip(w, zip(*pull)):
                v[gate] += lm.RATE * sum(g) / (len(pull) + lm.STEADY)
        for bucket, pull in refined.items():
            offsets[bucket] += lm.OFFSET_RATE * sum(pull) / (len(pull) + lm.STEADY)
    for v, found in zip(w, mixer.w):
        assert found[: lm.FOLLOWS] * lm.QUANT == pytest.approx(v[: lm.FOLLOWS], rel=1e-4, abs=1e-5)
    assert mixer.offsets[:32] == pytest.approx(offsets[:32], rel=1e-4, abs=1e-5)


def test_a_step_looks_up_the_decisions_of_all_depths_at_once(monkeypatch):
    """Scoring hashes once for each context of a step's words and bytes, however deep the trees."""
    texts = random_texts(7)
    tokens = lm.Tokens.of(texts)
    keys, n = lm.tallied(tokens.hash)
    coder = lm.coder_of(keys.view(np.int64), n, len(tokens.hash), 20, 4)
    assert coder.words.length.max() > 4 and coder.bytes.length.max() > 6
    tables, calls, slots = lm.empty_tables(coder), [], lm.slots
    monkeypatch.setattr(lm, "slots", lambda *args: calls.append(args) or slots(*args))
    own = np.zeros(len(texts), bool)
    lm.score_batch(tokens, lm.Passages(tokens, coder, own), lm.Answers(), lm.Corpus(len(tokens.hash), len(keys), len(texts), 0), coder, tables, lm.Mixer(lm.first_weights(), len(texts)))
    steps = int(lm.step_of(tokens.place).max()) + 1
    assert steps < len(calls) <= 5 * steps + 1


def test_shown_slots_and_sums_in_lanes_are_those_of_plain_formulas():
    draw = np.random.default_rng(4)
    coder = lm.Coder(np.array([4, 6], np.uint64), np.array([9, 4]), np.ones(2, bool), 2, np.ones(256, int))
    counts, tables = lm.Counts(coder), lm.empty_tables(coder)
    for table in counts.tables:
        at = draw.integers(0, len(table), len(table) // 3)
        table[at] = draw.choice([1, 2, 5, 126, 127, 128, 5000, 1 << 30], len(at))
    counts.show(tables)
    for table, x in zip(tables[1:], counts.tables[1:]):
        assert (table == lm.log_odds(*x.reshape(-1, 2).astype(np.float32).T)).all()
    at, x = draw.integers(0, 5, 1003), draw.normal(size=1003)
    for lanes in (1, 8):
        bins = lm.Bins(at, 6, lanes)
        assert bins.n.tolist() == np.bincount(at, minlength=6).tolist() and bins.sums(x) == pytest.approx(np.bincount(at, x, 6))


@pytest.mark.parametrize("frequent", [5, 1_000_000])
def test_scores_have_the_unigram_base_of_a_plain_count(spark, frequent):
    rows = [(1, "The cat\tsat on the mat"), (2, "the dog sat"), (3, None), (4, ""), (5, "a zebra é É"), (6, "the the the"), (6, "the the the"), (None, "cat")]
    held = F.col("doc_id").isin(5, 6)
    got = lm.score_texts(table(spark, rows), held, tree_words=4, frequent_keys=frequent, least_count=1).collect()
    count = Counter(w for k, t in rows if k not in (5, 6) for w in split(t or ""))
    total = sum(count.values())
    assert len(got) == len(rows) and all(r.train_tokens == total and r.score < 0 for r in got)
    want = sorted((-1 if k is None else k, len(ws := split(t or "")), sum(count[w] > 0 for w in ws), round(sum(math.log10((count[w] + 1) / (total + len(count) + 1)) for w in ws), 6)) for k, t in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    twins = {r.score for r in got if r.doc_id == 6}
    assert len(twins) == 1


@pytest.mark.parametrize("n", [1, 9_999, 10_000, 1_000_000])
def test_the_commonest_keys_fill_the_bound_within_one_count(spark, n):
    counts = spark.range(5000).select(F.xxhash64("id").alias("key"), F.when(F.col("id") < 50, n + 1 + F.col("id") % 3).otherwise(n).alias("n")).cache()
    keys, got, chosen = lm.frequent(counts, 1000)
    assert 990 <= len(set(keys)) == len(keys) <= 1000 and (got > n).sum() == 50
    assert counts.where(~chosen).count() == 5000 - len(keys)
    assert len(lm.frequent(counts, 20)[0]) in range(15, 21)
    assert [len(lm.frequent(counts, m)[0]) for m in (5000, 9000)] == [5000, 5000]
    assert len(lm.frequent(counts.limit(0), 10)[0]) == 0


def test_scores_without_rows_and_without_training_rows(spark):
    assert lm.score_texts(table(spark, []).limit(0), F.lit(False)).count() == 0
    got = lm.score_texts(table(spark, [(1, "all held out")]), F.lit(True)).collect()
    assert (got[0].train_tokens, got[0].n_known, got[0].n_tokens) == (0, 0, 4) and got[0].score < 0


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_model_beats_the_base_on_held_out_texts(spark, sf):
    got = [r for r in queries.op1_lm_score(spark, f"/root/testdata/sf{sf}").select("held_out", "score", "base_score").collect() if r.held_out]
    assert got and sum(r.score for r in got) > sum(r.base_score for r in got)


def test_texts_that_occur_twice_are_told_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    times = {r.text: r["count"] for r in docs.groupBy("text").count().collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r.bits_per_byte for r in queries.op1_lm_score(spark, "/root/testdata/sf0.01").collect()}
    once = sorted(b for d, b in got.items() if times[text[d]] == 1)
    twice = [b for d, b in got.items() if times[text[d]] == 2]
    assert sum(b < once[len(once) // 10] for b in twice) > 0.75 * len(twice) > 50


def test_probabilities_of_all_continuations_sum_to_one():
    """Summed over every symbol of its tree, a decision path has probability one."""
    words = [b"aa", b"bb", b"cc"]
    keys = np.array([word_hash(w) for w in words], np.uint64)
    coder = lm.Coder(keys, np.array([9, 4, 1]), np.ones(3, bool), 2, np.ones(256, int))
    tables = [np.random.default_rng(k).integers(-60, 60, 1 << b).astype(np.int8) for k, b in enumerate(lm.SLOT_BITS)]
    end = lm.Corpus(14, 3, 0, 0)

    def probability(word):
        """Of a text's first token alone."""
        tokens = lm.Tokens.of([word.decode()] if word else [""])
        if word:
            for name in ("hash", "start", "end", "text_of", "place"):
                setattr(tokens, name, getattr(tokens, name)[:1])
            tokens.sizes = np.array([1])
        passages = lm.Passages(tokens, coder, np.zeros(1, bool))
        start = lm.first_weights()
        start[0][0, lm.KNOWN :] = -40
        return math.exp(lm.score_batch(tokens, passages, lm.Answers(), end, coder, tables, lm.Mixer(start, 1))[0])

    total = sum(map(probability, words))
    spelled = sum(probability(bytes([c])) for c in range(33, 127) if not 65 <= c <= 90)
    assert 0 < total < 1 and total + spelled + probability(b"") < 1 + 1e-6

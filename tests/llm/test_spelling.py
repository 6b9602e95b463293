"""Spelling variants against every pair of words."""

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spanloom.llm import spelling


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def near_by_pairs(words: dict[str, int]) -> dict:
    out = {}
    for a in words:
        near = [(-words[b], b) for b in words if one_edit(a, b)]
        if near:
            out[a] = (len(near), -min(near)[0], min(near)[1])
    return out


@pytest.mark.parametrize("most", [2, 8, 256])
def test_near_words_against_all_pairs(spark, most):
    """A small alphabet makes dense blocks, runs of one letter and edits that fit at several places."""
    draw = random.Random(most)
    words = {"".join(draw.choice("abé") for _ in range(draw.randint(2, 9))): draw.randint(1, 9) for _ in range(700)}
    words |= {"a" * k: k for k in range(2, 12)} | {"日本語字": 3, "日本語": 3, "日木語字": 2}
    got = spelling.near_words(spark.createDataFrame(list(words.items()), "word string, n long"), most).collect()
    assert {r.word: (r.n_near, r.near_n, r.near) for r in got} == near_by_pairs(words)
    assert len(got) == len({r.word for r in got})


def test_one_block_that_holds_most_words(spark):
    """Words alike in all but their end: a block of one prefix holds them all and is divided."""
    draw = random.Random(1)
    words = {"prefixprefix" + "".join(draw.choice("abc") for _ in range(draw.choice([6, 6, 7]))): k % 7 for k in range(900)}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert spelling.divided(spelling.undivided(table)).groupBy("key").count().agg(F.max("count")).first()[0] > len(words) / 2
    assert {r.word: (r.n_near, r.near_n, r.near) for r in spelling.near_words(table, 16).collect()} == near_by_pairs(words)


def test_very_long_words(spark):
    a = "ab" * 30_000
    words = {a: 9, a[:40_000] + "x" + a[40_000:]: 2, a[:100] + "x" + a[101:]: 1, "c" * 60_000: 5}
    got = {r.word: (r.n_near, r.near) for r in spelling.near_words(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert {w: n for w, (n, _) in got.items()} == {w: len([v for v in words if one_edit(w, v)]) for w in words if w[0] != "c"}
    assert got[a][0] == 2


def test_strips_of_a_block(monkeypatch):
    draw = random.Random(3)
    rows = sorted({"".join(draw.choice("ab") for _ in range(4)): draw.randint(1, 5) for _ in range(40)}.items())
    short, long = [(w, n, False) for w, n in rows], [(w + "a", n, True) for w, n in rows]
    whole = [spelling.verified({"kind": k, "m": 4, "less": 5, "head": 0, "tail": 0, "rows": r}) for k, r in ((0, short), (1, short + long))]
    monkeypatch.setattr(spelling, "CELLS", 1)
    cut = [spelling.verified({"kind": k, "m": 4, "less": 5, "head": 0, "tail": 0, "rows": r}) for k, r in ((0, short), (1, short + long))]
    assert [sorted(x) for x in whole] == [sorted(x) for x in cut]


def test_runs_lose_a_letter_by_their_hash():
    text = "Straße ÀÉ abc, ABC's Zoo×ab"
    got = spelling.runs_of(text, "5", 2)
    want = Counter()
    for run in ("straße", "ÀÉ", "abc", "abc", "s", "zoo×ab"):
        h = zlib.crc32(f"5:{run}".encode())
        want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 2 == 0 else run] += 1
    assert got == want


def test_forms_and_roots(spark):
    """Chains of forms, a tie for the commonest near word, a form just under the ratio."""
    text = " ".join(["planets"] * 250 + ["planetz"] * 50 + ["planeez"] * 10 + ["plaeez"] * 2 + ["plaeeez"] * 2 + ["garden"] * 10 + ["gardem"] * 10 + ["garde"] * 2 + ["gardenx"] * 3)
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    got = {r.word: r for r in spelling.spelling_variants(docs, every=1 << 40, least_length=5, least_count=2).collect()}
    chain = [(r.form, r.root) for r in (got[w] for w in ("planets", "planetz", "planeez", "plaeez", "plaeeez"))]
    assert chain == [(None, "planets"), ("planets", "planets"), ("planetz", "planets"), ("planeez", "planets"), ("planeez", "planets")]
    assert (got["garde"].form, got["garde"].form_n, got["garde"].n_near) == ("gardem", 10, 2)  # the smaller of two as common
    assert got["gardenx"].form is None and got["gardenx"].root == "gardenx" and got["gardenx"].n_near == 1


def test_rows_that_repeat_nulls_and_other_columns(spark):
    rows = [(1, "alphabet", "a"), (1, "alphabet", "a"), (None, "alphabet Alphabet", "b"), (2, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string").withColumnRenamed("word", "n.word")
    got = spelling.spelling_variants(docs, every=1 << 40, least_count=4).collect()
    assert [(r.word, r.n, r.form, r.root, r.n_near, r.form_n) for r in got] == [("alphabet", 4, None, "alphabet", 0, None)]
    assert spelling.spelling_variants(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_variants(docs, least_length=1)

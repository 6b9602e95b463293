"""Divergence of sources against loops over every pair and every term."""

import random
import re
from collections import Counter, defaultdict

import pytest

from spanloom.llm import divergence

SCHEMA = "text string, lang string, source string"


def plain(rows, least_docs=3, top=200):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups.add((lang, source))
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang, source in groups:
        kept = [w for w, n in docs[lang].items() if n >= least_docs]
        p = {}
        for s in [s for g, s in groups if g == lang] + [None]:
            c = counts[lang, s] if s is not None else sum((counts[g] for g in groups if g[0] == lang), Counter())
            total = sum(c[w] for w in kept)
            p[s] = {w: 1 + 1_000_000_000 * (c[w] + 1) // (total + len(kept)) for w in kept}
        f = lambda a, b: (a - b) ** 2 // b
        pairs = [(s, sum(f(p[source][w], p[s][w]) for w in kept)) for s in p if s not in (source, None)]
        terms = [(w, f(p[source][w], p[None][w])) for w in kept if counts[lang, source][w] and p[source][w] > p[None][w]]
        for part, items, most in (("pair", pairs, None), ("term", terms, top)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def drawn(seed, n=120):
    draw = random.Random(seed)
    words = ["The", "the", "été", "日本", "x", *(f"{a}{b}" for a in "abcd" for b in "xyzw")]
    rows = [(" ".join(draw.choice(words[: draw.randint(4, len(words))]) for _ in range(draw.randint(0, 30))) + ", 12", draw.choice(["en", "fr"]), draw.choice(["hot", "hot", "s1", "s2", "é", "z"])) for _ in range(n)]
    return rows + [(None, "en", "empty"), ("only here", "xx", "a"), (None, None, None), ("the the", None, "b"), rows[0], rows[0]]


def collected(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("most_groups", [divergence.GROUPS, 2])
def test_against_loops(spark, monkeypatch, most_groups):
    """Totals by broadcast and by a join; chunks of a few rows; few terms reported."""
    rows = drawn(5)
    docs = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", term int")
    assert collected(divergence.source_divergence(docs, most_groups=most_groups)) == plain(rows)
    monkeypatch.setattr(divergence, "ROWS", 7)
    assert collected(divergence.source_divergence(docs, least_docs=1, top=3, most_groups=most_groups)) == plain(rows, 1, 3)


def test_counts_flushed_early(spark, monkeypatch):
    rows = drawn(6)
    monkeypatch.setattr(divergence, "HELD", 5)
    assert collected(divergence.source_divergence(spark.createDataFrame(rows, SCHEMA).coalesce(1))) == plain(rows)


def test_no_kept_terms_and_empty_table(spark):
    rows = [("one", "en", "a"), ("two", "en", "b"), ("", "en", "c")]
    got = collected(divergence.source_divergence(spark.createDataFrame(rows, SCHEMA)))
    assert got == plain(rows) and {r[4] for r in got} == {0} and len(got) == 6
    assert divergence.source_divergence(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_very_long_text_and_a_very_common_term(spark):
    rows = [("word " * 300_000 + "x" * 1_000_000, "en", "a")] + [("word other", "en", s) for s in "ab" * 4]
    assert collected(divergence.source_divergence(spark.createDataFrame(rows, SCHEMA))) == plain(rows)

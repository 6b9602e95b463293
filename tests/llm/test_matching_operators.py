"""Near duplicates, decontamination, search, URL rules, preferences, languages, the pipeline."""

import math
import random
from itertools import combinations

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm import decontaminate, language_id, near_dedup, preferences, queries, top_k, url_filter
from spanloom.llm.words import bare, split


def shingled(text):
    w = split(text)
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def plain_groups(rows, percent):
    """Row -> smallest doc_id that links reach, by all pairs."""
    sets, up = [shingled(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            up[root(a)] = root(b)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(root(k), []).append(k)
    return groups


def copies(seed):
    """Texts with copies of many degrees around a shared middle, a chain, and short texts."""
    pick = random.Random(seed)
    words = [f"w{k}" for k in range(3000)]
    rows = []
    for _ in range(12):
        base = pick.choices(words, k=pick.randint(30, 200))
        for _ in range(pick.randint(1, 14)):
            own = list(base)
            for _ in range(pick.randint(0, max(1, len(base) // 40))):
                own[pick.randrange(len(own))] = pick.choice(words)
            rows.append(" ".join(own))
    rows += ["one two", "One  TWO", "one two three four five six", "", " \n", None, "solo"]
    pick.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("percent, seed", [(85, 1), (80, 2)])
def test_near_duplicates_are_those_of_all_pairs(spark, percent, seed):
    rows = copies(seed)
    df = spark.createDataFrame([(k, t, 0) for k, t in rows], "doc_id long, text string, kept int").repartition(4)
    got = {r.doc_id: r for r in near_dedup.near_duplicates(df, percent=percent).collect()}
    for members in plain_groups(rows, percent).values():
        for k in members:
            assert (got[k].component_id, got[k].kept, got[k].n_shingles) == (min(members), k == min(members), len(shingled(rows[k][1])))
    kept = near_dedup.drop_near_duplicates(df, percent=percent)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.kept}


def test_near_duplicates_with_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (4, None), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect())
    assert got == [(0, 3, False), (3, 3, True), (3, 3, True), (4, 4, True), (4, 4, True)]
    assert sorted(r.doc_id for r in near_dedup.drop_near_duplicates(df).collect()) == [3, 4, 4]
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def test_min_max_signatures_estimate_similarity():
    draw = np.random.default_rng(0).integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = np.sort(draw[:2000]), np.sort(draw[500:2500])
    s = near_dedup.min_max([a, b])
    assert abs((s[0] == s[1]).mean() - 1500 / 2500) < 0.13
    assert s.shape == (2, 2 * near_dedup.PERMUTATIONS)


def test_masks_meet_every_overlap_that_verifies():
    for n in range(decontaminate.LEAST_WORDS, decontaminate.WINDOW + 1):
        masks = decontaminate.masks_of(n, 80)
        for bad in combinations(range(n), n * 20 // 100):
            assert any(all(m[k] == "0" or a + k not in bad for k in range(len(m))) for m in masks for a in range(n - len(m) + 1)), (n, bad)


def plain_overlap(doc, item):
    n = min(decontaminate.WINDOW, len(item))
    return n >= 5 and any(sum(doc[d + k] == item[i + k] for k in range(n)) * 100 >= 80 * n for i in range(len(item) - n + 1) for d in range(len(doc) - n + 1) if len(item) >= decontaminate.WINDOW or i == 0)


def test_contamination_is_that_of_all_alignments(spark):
    pick = random.Random(9)
    words = [f"v{k}" for k in range(400)]
    items = [(k, " ".join(pick.choices(words, k=n))) for k, n in enumerate([4, 5, 6, 8, 10, 11, 13, 20, 30, 30])] + [(None, None), (99, "")]
    docs = []
    for k in range(120):
        own = pick.choices(words, k=pick.randint(0, 60))
        item = (pick.choice(items)[1] or "").split()
        at = pick.randint(0, max(0, len(item) - 13))
        part = item[at : at + pick.choice([9, 13, 18])]
        for _ in range(pick.randint(0, 4) if part else 0):
            part[pick.randrange(len(part))] = "changed"
        own[len(own) // 2 : len(own) // 2] = [w.upper() + pick.choice(["", ".", ","]) for w in part]
        docs.append((k, " ".join(own)))
    docs += [(500, None), (501, "")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, item_id string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench).collect()}
    cut = lambda t: [bare(w) for w in split(t)]
    want = {(d, i) for d, t in docs for i, x in items if plain_overlap(cut(t), cut(x))}
    assert got == want and len(want) > 20
    left = decontaminate.clean(df, bench)
    assert left.columns == df.columns and {r.doc_id for r in left.collect()} == {d for d, _ in docs} - {d for d, _ in want}
    assert decontaminate.clean(df, bench.limit(0)).count() == len(docs)


def test_top_k_is_that_of_all_products(spark):
    draw = np.random.default_rng(2)
    rows = [(k, [float(x) for x in draw.normal(size=20) * draw.choice([0.1, 1, 5])]) for k in range(400)]
    rows += [(100, rows[7][1]), (401, None), (402, [1.0, None] + [0.0] * 18), (403, [float("nan")] * 20), (404, [float("inf")] * 20), (405, [0.5, 0.5]), (None, [1.0] * 20)]
    rows += [(k, rows[3][1]) for k in range(500, 530)]  # ties
    df = spark.createDataFrame([(k, v, 1) for k, v in rows], "vec_id long, embedding array<double>, score int").repartition(5)
    got = sorted(tuple(r) for r in top_k.top_k(df, F.col("vec_id") % 100 == 0, k=10).select("query_id", "rank", "vec_id", "score").collect())
    good = [(k, [math.floor(1024 * x) for x in v]) for k, v in rows if k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for at, (q, v) in enumerate(good):
        if q % 100 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), k) for j, (k, w) in enumerate(good) if j != at and len(w) == len(v))[:10]
            want += [(q, r, k, -s) for r, (s, k) in enumerate(found, 1)]
    assert got == sorted(want)
    assert top_k.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


URLS = ["https://Sub.Example.NET/en/a?x#y", "http://example.net/de/", "ftp://example.com/de/x", "http://notexample.com/de/", "http://a.org/fr/z", "http://a.org/en/", "no scheme", None, "", "http://", "x://h", "a://b://c/d?e", "http://net/", "https://h.com?q=/de/", "HTTP://ORG/fr/\nline", *(f"http://good.org/fr/page{k}" for k in range(60)), *(f"http://casino{k}.net/win-now" for k in range(60)), *(f"http://casino{k}.com/win-now" for k in range(20)), *(f"http://good.com/fr/page{k}" for k in range(20))]


def plain_url(u):
    host = path = ""
    if u and "://" in u:
        rest = u.split("://", 1)[1]
        ends = [rest.find(c) for c in "/?#" if c in rest]
        at = min(ends, default=len(rest))
        host = "".join(c.lower() if c < "\x80" else c for c in rest[:at])
        path = rest[at:].split("?")[0].split("#")[0]
    best = None
    for verdict, rule in queries.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    return host, path, best


def test_url_rules_and_method(spark):
    df = spark.createDataFrame([(k, u, "old") for k, u in enumerate(URLS)], "page_id long, url string, verdict string")
    got = {r.page_id: r for r in url_filter.filter_urls(df, queries.RULES).collect()}
    assert len(got) == len(URLS)
    for k, u in enumerate(URLS):
        host, path, best = plain_url(u)
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, best and best[1]), u
        if best:
            assert got[k].verdict == best[0]
        if u and u.startswith("http://casino"):
            assert got[k].verdict == "block"
        if u and u.startswith("http://good"):
            assert got[k].verdict == "allow"
    assert {got[k].verdict for k in got} == {"allow", "block"}
    assert url_filter.filter_urls(df.limit(0), queries.RULES).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(df.where("url like '%good.com%'"), queries.RULES).collect()} == {"allow"}


def test_preferences(spark):
    def turns(pair, side, *said):
        return [(pair, side, k, r, t, "extra") for k, (r, t) in enumerate(said)]

    rows = turns(1, "chosen", ("user", "q"), ("assistant", "good"), ("user", None)) + turns(1, "rejected", ("user", "q"), ("assistant", "bad"))
    rows += turns(2, "chosen", ("user", "a")) + turns(3, "chosen", (None, "x")) + turns(3, "rejected", (None, "x")) + turns(None, "chosen", ("user", "gone")) + turns(4, "other", ("user", "gone"))
    df = spark.createDataFrame(rows, "pair_id long, side string, turn int, role string, text string, prompt string")
    got = {r.pair_id: r for r in preferences.format_preferences(df).collect()}
    assert set(got) == {1, 2, 3}
    one = got[1]
    assert (one.prompt_turns, one.prompt) == (1, "<|im_start|>user\nq<|im_end|>\n")
    assert one.chosen == "<|im_start|>assistant\ngood<|im_end|>\n<|im_start|>user\n<|im_end|>\n" and one.rejected == "<|im_start|>assistant\nbad<|im_end|>\n"
    for side in ("chosen", "rejected"):
        assert sum(x.chars for x in one[f"{side}_runs"]) == len(one[side])
        at, trained = 0, ""
        for x in one[f"{side}_runs"]:
            trained += one[side][at : at + x.chars] if x.train else ""
            at += x.chars
        assert trained == {"chosen": "good", "rejected": "bad"}[side] + "<|im_end|>\n"
    assert (got[2].prompt, got[2].rejected, got[2].rejected_runs) == ("", None, None)
    assert (got[3].prompt_turns, got[3].chosen, got[3].rejected, got[3].chosen_runs) == (1, "", "", [])
    assert preferences.format_preferences(df.limit(0)).count() == 0


def test_languages_of_texts_that_were_not_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").dropDuplicates(["text"])
    learned = F.pmod(F.xxhash64("text"), F.lit(2)) == 0
    model = language_id.fit(docs.where(learned), "text", "lang", per_language=60)
    got = language_id.identify(docs.where(~learned).drop("n_chars"), model, host=F.col("source")).where("length(text) > 200").collect()
    assert sum(r.text_language == r.lang for r in got if r.accepted) > 0.9 * sum(r.accepted for r in got) > 0.8 * len(got)


def test_every_label_is_modelled(spark, monkeypatch):
    """230 languages, each of its own letters; the last of them has one text only."""
    own = lambda k: " ".join(chr(0x4E00 + 40 * k + j) * 2 for j in range(30))
    rows = [(f"l{k:03}", own(k) + f" {j}") for k in range(230) for j in range(1 if k == 229 else 2)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    model = language_id.fit(df, "text", "lang")
    assert model[0] == [f"l{k:03}" for k in range(230)]
    got = language_id.identify(df.where("lang in ('l000', 'l150', 'l229')"), model).collect()
    assert len(got) == 5 and all(r.text_language == r.lang and r.accepted for r in got)
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 229)
    with pytest.raises(ValueError):
        language_id.fit(df, "text", "lang")


def test_language_sample_is_of_distinct_texts_by_hash(spark):
    rows = [("en", f"text {k} {chr(97 + k % 26) * 3}") for k in range(300)] + [("en", "zq zq zq")] * 500
    df = spark.createDataFrame(rows, "lang string, text string")
    one, many = df.coalesce(1).orderBy("text"), df.repartition(7).orderBy(F.desc("text"))
    a, b, c = (language_id.fit(d, "text", "lang", per_language=200)[1] for d in (one, many, df.distinct()))
    assert (a == b).all() and (a == c).all()


def test_language_edge_rows(spark):
    docs = [(1, "the cat and the dog went over the hill " * 9, "en", "h"), (2, "der hund und die katze gingen nach hause " * 9, "de", "h")]
    model = language_id.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"), "text", "lang")
    rows = docs + [(3, None, "en", None), (4, "", None, "h"), (5, " \n ", "xx", "h"), (6, "0192837465 91827 " * 40, "en", "h"), (7, "the cat and the dog " * 4, None, None), (7, "the cat and the dog " * 4, None, None)]
    df = spark.createDataFrame([(*r, "old") for r in rows], "doc_id long, text string, lang string, source string, confidence string")
    got = language_id.identify(df, model, declared=F.col("lang"), host=F.col("source")).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and by[1].language == by[7].language == "en" and by[2].language == "de" and by[1].accepted and by[2].accepted
    assert not any(by[k].accepted for k in (3, 4, 5, 6)) and by[3].text_language is None
    assert language_id.identify(df.limit(0), model).count() == 0
    assert not any(r.accepted for r in language_id.identify(df, language_id.fit(df.limit(0), "text", "lang")).collect())


def test_pipeline_keeps_what_each_stage_keeps(spark, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near duplicates", "decontamination", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    spoken = corpus_pipeline.language(spark, docs, sf_dir)
    kept = sorted((r.doc_id, r.text) for r in spoken.collect())
    assert spoken.columns == docs.columns and len(kept) > 0.9 * docs.count()
    want = {kept[min(m)] for m in plain_groups(kept, 80).values()}
    assert {(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, spoken, sf_dir).collect()} == want
    cut = lambda t: [bare(w) for w in split(t)]
    items = [cut(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    first = {tuple(i[k : k + 3]) for i in items for k in range(len(i) - 2)}
    clean = {d for d, t in want if not ((w := cut(t)) and any(tuple(w[k : k + 3]) in first for k in range(len(w))) and any(plain_overlap(w, i) for i in items))}
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).select("doc_id").distinct().collect()} == clean

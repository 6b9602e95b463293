"""The URL models and the fused language posterior against plain versions; clashing
names, ranges and long texts."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm import decontaminate, language_id, near_dedup, packing, queries, token_files, tokens, top_k, url_filter
from spanloom.session import new_folder


def plain_symbols(url):
    out = []
    for c in url:
        c = c.lower() if c < "\x80" else c
        c = "0" if c in "0123456789" else c
        out.append(c if c in "abcdefghijklmnopqrstuvwxyz0" + url_filter.MARKS else "~")
    return "^^^" + "".join(out) + "$"


def plain_ratios(taught):
    """taught: (url, label, weight).  log P(sign | three before) of accepted less that of rejected URLs."""
    counts = {label: Counter() for label in ("allow", "block")}
    for url, label, w in taught:
        s = plain_symbols(url)
        for k in range(3, len(s)):
            for order in range(4):
                counts[label][s[k - order : k], s[k]] += w
    under = {label: Counter() for label in counts}
    for label, c in counts.items():
        for (h, _), n in c.items():
            under[label][h] += n

    def p(label, h, c):
        below = p(label, h[1:], c) if h else 1 / 41
        return (counts[label][h, c] + url_filter.STRENGTH * below) / (under[label][h] + url_filter.STRENGTH)

    return lambda h, c: math.log(p("allow", h, c)) - math.log(p("block", h, c))


def test_url_scores_are_those_of_plain_markov_models(spark):
    urls = [f"http://site{k % 7}.{'org' if k % 2 else 'com'}/{'fr' if k % 2 else 'de'}/page-{k}?id={k * 37}" for k in range(90)] + ["http://x.net/WIN%20now", None, "", "no scheme é"] * 2
    df = spark.createDataFrame([(k, u, "allow" if k % 2 else "block", 1, 2) for k, u in enumerate(urls)], "page_id long, url string, label string, u_url int, w int")
    label = F.when(F.col("page_id") < 70, F.col("label"))
    got = url_filter.filter_urls(df, [("block", "net/")], label=label)
    assert got.columns[:5] == ["page_id", "url", "label", "u_url", "w"]
    times, given = Counter(u for u in urls if u is not None), {}
    for k, u in enumerate(urls):
        if k < 70:
            given[u] = "allow" if k % 2 else "block"
    held = lambda u: hashlib.md5(u.encode()).hexdigest()[0] in "012"
    ratio = plain_ratios([(u, x, times[u]) for u, x in given.items() if not held(u)])
    score = {u: sum(ratio(s[k - 3 : k], s[k]) for k in range(3, len(s))) / (len(s) - 3) for u in times for s in [plain_symbols(u)]}
    folds = {x: [score[u] for u, y in given.items() if y == x and held(u)] for x in ("allow", "block")}
    (a, sa), (r, sr) = ((np.mean(folds[x]), np.std(folds[x])) for x in ("allow", "block"))
    least = (a * sr + r * sa) / (sa + sr)
    for row in got.collect():
        if row.url is None:
            assert (row.score, row.verdict) == (None, "allow")
        else:
            assert row.score == pytest.approx(score[row.url], abs=1e-9)
            assert row.verdict == ("block" if row.rule or score[row.url] < least else "allow")


def test_hot_urls_and_those_with_clashing_columns_keep_their_rows(spark):
    df = spark.createDataFrame([(f"http://a{k}.org/x",) for k in range(5)] * 20 + [(None,)] * 30, "url string")
    df = df.withColumns({"_hot": F.lit(1), "_KEY": F.lit(2), "_hot_score": F.lit(3), "u": F.lit(4)})
    got = url_filter.filter_urls(df, queries.RULES)
    assert got.columns == [*df.columns, "host", "path", "rule", "score", "verdict"] and got.count() == df.count()
    assert {(r._hot, r["_KEY"], r.u) for r in got.collect()} == {(1, 2, 4)}


def plain_posterior(rows, model, columns):
    """rows: (text, declared, suffix, host).  Language, confidence, whether it beats no language."""
    names, table = model
    n = len(names)
    logs = []
    for text, *_ in rows:
        data = language_id.squeezed(text)
        pairs = [data[k] << 8 | data[k + 1] for k in range(len(data) - 1)] if len(data) > 2 else []
        scale = min(1.0, language_id.EVIDENCE / max(1, len(pairs)))
        logs.append(([scale * sum(float(table[k][g]) for g in pairs) for k in range(n)], scale * len(pairs) * -math.log(48), len(pairs)))
    soft = lambda x: [math.exp(v - max(x)) / sum(math.exp(u - max(x)) for u in x) for v in x]
    p = [soft(t) if size else [0.0] * n for t, _, size in logs]
    whole = [sum(x[k] for x in p) for k in range(n)]
    overall = [(x + 1) / (sum(whole) + n) for x in whole]
    sums = defaultdict(lambda: [0.0] * n)
    for (_, d, s, h), x in zip(rows, p):
        for key in (("d", d), ("s", s), ("h", s, h)):
            sums[key] = [a + b for a, b in zip(sums[key], x)]
    out = []
    for (_, d, s, h), (t, none, size), own in zip(rows, logs, p):
        above = overall
        for key in ([("s", s)] if s is not None else []), ([("h", s, h)] if h is not None else []):
            for k in key:
                others = [max(0.0, a - b) for a, b in zip(sums[k], own)]
                above = [(o + q * language_id.STRENGTH) / (sum(others) + language_id.STRENGTH) for o, q in zip(others, above)]
        spoken = [math.log((sums["d", d][k] + 1) / (whole[k] + 2)) if d is not None else 0.0 for k in range(n)]
        fused = soft([a + math.log(q) + b for a, q, b in zip(t, above, spoken)])
        best = max(range(n), key=lambda k: (fused[k], -k))
        out.append((names[best], fused[best], size > 0 and t[best] > none))
    return out


def test_fused_language_is_that_of_a_plain_posterior(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_id.fit(docs, "text", "lang", per_language=20)
    some = docs.orderBy("doc_id").limit(70).collect()
    rows = [(r.text[: 3 + 5 * (k % 9)], None if k % 5 == 0 else r.lang, None if k % 7 == 0 else r.source[-1], None if k % 4 == 0 else r.source) for k, r in enumerate(some)] + [(None, "en", "1", "src1"), ("", None, None, None)]
    df = spark.createDataFrame([(k, *r, "old", 1.5) for k, r in enumerate(rows)], "id long, text string, declared string, s string, _h string, language string, p double")
    got = language_id.identify(df, model, declared=F.col("declared"), suffix=F.col("s"), host=F.col("_h"))
    assert got.columns == ["id", "text", "declared", "s", "_h", "p", "language", "confidence", "text_language", "accepted"]
    for r, (name, confidence, better) in zip(sorted(got.collect(), key=lambda r: r.id), plain_posterior(rows, model, None), strict=True):
        assert r.confidence == pytest.approx(confidence, rel=1e-5) and r.p == 1.5
        if rows[r.id][0]:
            assert (r.language, r.accepted) == (name, better and confidence >= 0.5)
    assert language_id.identify(df, model, columns=["id"]).columns == ["id", "language", "confidence", "text_language", "accepted"]


def test_languages_of_pages(spark, sf_dir):
    html = "<HTML lang='de'><head><style>p {x}</style></head><!-- c --><body><p>Guten&nbsp;Tag <script>var a = 1 < 2;</script>Welt</p></body>"
    got = spark.createDataFrame([(html,), ("plain <b>text",), (None,)], "html string").select(language_id.page_text(F.col("html")).alias("t"), language_id.page_declared(F.col("html")).alias("d")).collect()
    assert [(r.t and r.t.split(), r.d) for r in got] == [(["Guten", "Tag", "Welt"], "de"), (["plain", "text"], None), (None, None)]
    found = queries.op10_language_id_pages(spark, sf_dir)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    assert found.count() == pages.count() and found.where("accepted").count() > 0.5 * pages.count()


@pytest.mark.parametrize("clusters, n", [(2, 100), (2, 200), (6, 20), (6, 80)])
def test_clusters_in_a_bucket_are_not_paired_out(spark, monkeypatch, clusters, n):
    """Copies of texts that share two thirds of their words; each copy changes one word of its own."""
    words = [[f"w{k}" if k < 80 else f"v{c}-{k}" for k in range(120)] for c in range(clusters)]
    rows = []
    for k in range(clusters * n):
        own = list(words[k % clusters])
        own[(k * 7) % 120] = f"own{k}"
        rows.append((k, " ".join(own), k))
    df = spark.createDataFrame(rows, "doc_id long, text string, _k int")
    pairs, around = [], near_dedup.around_pivots

    def counted(*args):
        out = around(*args)
        pairs.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "around_pivots", counted)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df).collect()}
    assert got == {k: k % clusters for k in range(clusters * n)}
    # All pairs would be n / 2 times the texts; with six clusters what is left after two rounds still grows faster than they do.
    assert sum(pairs) <= (2 if clusters == 2 else 5) * clusters * n
    kept = near_dedup.drop_near_duplicates(df)
    assert kept.columns == df.columns and sorted((r.doc_id, r["_k"]) for r in kept.collect()) == [(c, c) for c in range(clusters)]


def test_no_pair_at_the_threshold_is_lost():
    """Of pairs of similarity 85 %, nearly all share a band; the rest is expected once in two million."""
    draw, missed = np.random.default_rng(3), 0
    for _ in range(400):
        both = draw.integers(0, 1 << 63, 85 + 15, dtype=np.uint64)
        a, b = np.unique(both[:92]), np.unique(np.concatenate([both[:85], both[92:]]))
        keys = near_dedup.band_keys(near_dedup.min_max([a, b]), 5)
        missed += not (keys[0] == keys[1]).any()
    assert missed == 0


def test_clashing_names_stay_in_what_decontamination_keeps(spark):
    df = spark.createDataFrame([(1, "nothing here", 5, 6), (2, " ".join(f"w{k}" for k in range(20)), 7, 8)], "doc_id long, text string, _k int, _K_ int")
    bench = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(20)))], "item_id long, text string")
    assert [tuple(r) for r in decontaminate.clean(df, bench).collect()] == [(1, "nothing here", 5, 6)]
    short = spark.createDataFrame([(3, " ".join(f"w{k}" for k in range(9)))], "doc_id long, text string")
    assert decontaminate.clean(short, bench).count() == 1


def test_products_beyond_a_long_are_held_at_its_end(spark):
    df = spark.createDataFrame([(100, [1e30, 1.0]), (1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [0.5, 0.5])], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.score for r in top_k.top_k(df, F.col("vec_id") == 100).collect()}
    assert got[1] == (1 << 63) - 1 and got[2] == -(1 << 63) and set(got) == {1, 2, 3}


def test_every_row_may_be_a_query(spark):
    draw = np.random.default_rng(4)
    rows = [(k, [float(x) for x in draw.normal(size=8)]) for k in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {(r.query_id, r["rank"]): r.score for r in top_k.top_k(df, F.lit(True), k=3).collect()}
    whole = np.floor(1024 * np.array([v for _, v in rows])).astype(np.int64)
    scores = whole @ whole.T
    np.fill_diagonal(scores, -(1 << 60))
    want = -np.sort(-scores, 1)[:, :3]
    assert got == {(q, r + 1): int(want[q, r]) for q in range(300) for r in range(3)}


def test_a_long_text_is_cut_in_proportion():
    p = packing.Packer(4, 2, 1, 0)
    p.add(7, 0, 403, np.arange(403, dtype="<u4").tobytes())
    assert [r[4][0]["start"] for r in p.out] == list(range(0, 400, 4)) and p.open[0][0] == 1


def test_long_chunks_are_not_kept():
    c = tokens.Chunks(lambda new: [len(x) for x in new], 10)
    c.learn({"a", "b" * 99})
    assert c["b" * 99] == 99
    c.learn({"c"})
    assert set(c) == {"a", "c"}


def test_ids_take_the_width_that_the_tokenizer_needs(spark, tmp_path):
    path = str(tmp_path / "wide.json")
    from tokenizers import Tokenizer, models, pre_tokenizers

    wide = Tokenizer(models.WordLevel({"a": 0, "b": 70_000, "[UNK]": 5}, unk_token="[UNK]"))
    wide.pre_tokenizer = pre_tokenizers.Whitespace()
    wide.save(path)
    monkey = token_files.encode_texts
    try:
        token_files.encode_texts = lambda p, kind, texts: iter(tokens.id_bytes(p, [t or "" for t in texts]))
        to = new_folder(spark, "wide")
        token_files.write_token_files(spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), to, path)
    finally:
        token_files.encode_texts = monkey
    assert np.frombuffer(token_files.read_token_files(spark, to).first().ids, "<u4").tolist() == [0, 70_000, 5, 2]

"""Columns whose names need quoting stay as they are, and so does what they hold."""

import public_tokenizers
from pyspark.sql import functions as F

from spanloom.llm import language_id, token_counts, top_k, url_filter

ODD = ["a.b", "c`d", "e f", "ümlaut", "text.x"]


def with_odd(df):
    for k, n in enumerate(ODD):
        df = df.withColumn(n, F.struct(F.lit(k).alias("in ner"), F.lit(None).cast("int").alias("x.y")))
    return df


def kept(df):
    return [(n, df.schema[n].dataType.simpleString()) for n in ODD] if all(n in df.columns for n in ODD) else None


def test_url_filter(spark):
    pages = with_odd(spark.createDataFrame([(1, "http://a.net/"), (2, None), (3, "http://b.org/")], "page_id long, url string"))
    got = url_filter.filter_urls(pages, [("block", "net/")])
    assert kept(got) == kept(pages) and {r.page_id: r.verdict for r in got.collect()} == {1: "block", 2: "allow", 3: "allow"}
    assert {r["a.b"]["in ner"] for r in got.collect()} == {0}


def test_language_id(spark):
    docs = with_odd(spark.createDataFrame([(k, "the quick brown fox " * 5 if k % 2 else "le renard brun rapide " * 5, "en" if k % 2 else "fr") for k in range(40)], "doc_id long, text string, lang string"))
    model = language_id.fit(docs, "text", "lang")
    got = language_id.identify(docs, model)
    assert kept(got) == kept(docs) and all(r.language == r.lang for r in got.collect())
    none = language_id.identify(docs, ([], None))
    assert kept(none) == kept(docs) and none.where("accepted").count() == 0


def test_token_counts(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = with_odd(spark.createDataFrame([(1, "some words here"), (2, None)], "doc_id long, text string"))
    got = token_counts.count_tokens(docs, path)
    assert kept(got) == kept(docs) and got.columns == ["doc_id", *ODD, "n_bytes", "n_tokens", "over_limit"]
    assert {r.doc_id: (r.n_bytes, r.n_tokens > 0) for r in got.collect()} == {1: (15, True), 2: (0, False)}
    renamed = docs.withColumnRenamed("text", "my.text")
    assert token_counts.count_tokens(renamed, path, text="my.text").count() == 2


def test_top_k_unpacks_queries_alone(spark):
    rows = [(k, [float(k % 7), float(k % 5), 1.0]) for k in range(500)] + [(None, [1.0, 1.0, 1.0]), (600, None)]
    v = with_odd(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = top_k.top_k(v, F.col("vec_id") % 100 == 0, 3).collect()
    whole = {k: [1024 * int(x) for x in e] for k, e in rows if k is not None and e}
    for q in range(0, 500, 100):
        want = sorted((-sum(a * b for a, b in zip(whole[q], whole[c])), c) for c in whole if c != q)[:3]
        assert sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q) == [(k + 1, c, -s) for k, (s, c) in enumerate(want)]
    assert len(got) == 15

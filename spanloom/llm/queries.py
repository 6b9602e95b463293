"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from spanloom.llm import decontaminate, divergence, language_id, lm_score, near_dedup, packing, preferences, spelling, token_counts, token_files, top_k, url_filter, warc
from spanloom.session import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2
    return lm_score.score_texts(table(spark, sf_dir, "documents"), held_out)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.digest(packed)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2k and 2k + 1 are the chosen and the rejected answer of pair k."""
    turns = table(spark, sf_dir, "conversations").select(
        F.floor(F.col("conv_id") / 2).alias("pair_id"), F.when(F.pmod("conv_id", F.lit(2)) == 0, "chosen").otherwise("rejected").alias("side"), "turn", "role", "text"
    )
    mask = lambda c: F.array_join(F.transform(c, lambda r: F.concat(r["chars"].cast("string"), F.when(r["train"], ":1").otherwise(":0"))), ",")
    return preferences.format_preferences(turns).withColumns({"chosen_runs": mask("chosen_runs"), "rejected_runs": mask("rejected_runs")})


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.fit(docs, "text", "lang"), declared=F.col("lang"), host=F.col("source"), columns=["doc_id"])
    return found.select("doc_id", "language", F.round("confidence", 6).alias("confidence"), "text_language", "accepted")


def op10_language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over web pages, with markup, address suffix and host."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    host = url_filter.host_of(F.col("url"))
    folder = F.regexp_extract(url_filter.path_of(F.col("url")), "^/([a-z]{2})/", 1)
    seen = pages.select("page_id", language_id.page_text(F.col("html")).alias("text"), language_id.page_declared(F.col("html")).alias("d"), F.concat_ws("/", F.substring_index(host, ".", -1), folder).alias("s"), host.alias("h"))
    found = language_id.identify(seen, language_id.fit(docs, "text", "lang"), declared=F.col("d"), suffix=F.col("s"), host=F.col("h"), columns=["page_id"])
    return found.select("page_id", "language", F.round("confidence", 6).alias("confidence"), "text_language", "accepted")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path, payload=False).drop("url", "payload")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_score": op1_lm_score,
    "op2_packing": op2_packing,
    "op3_decontamination": op3_decontamination,
    "op4_token_files": op4_token_files,
    "op5_near_dedup": op5_near_dedup,
    "op6_preferences": op6_preferences,
    "op7_url_filter": op7_url_filter,
    "op8_top_k": op8_top_k,
    "op9_token_counts": op9_token_counts,
    "op10_language_id": op10_language_id,
    "op10_language_id_pages": op10_language_id_pages,
    "op11_spelling": op11_spelling,
    "op12_warc": op12_warc,
    "op13_divergence": op13_divergence,
}
ORACLE_SQL: dict[str, str] = {
    "op6_preferences": """
WITH t AS (
  SELECT conv_id // 2 AS pair_id, conv_id % 2 AS side,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k, role, text,
    '<|im_start|>' || coalesce(role, '') || chr(10) AS h, coalesce(text, '') || '<|im_end|>' || chr(10) AS b
  FROM conversations),
n AS (SELECT pair_id, least(count(*) FILTER (side = 0), count(*) FILTER (side = 1)) AS least, count(*) FILTER (side = 0) AS nc, count(*) FILTER (side = 1) AS nr FROM t GROUP BY 1),
d AS (
  SELECT a.pair_id, min(a.k) AS k FROM t a JOIN t b ON a.pair_id = b.pair_id AND a.k = b.k AND a.side = 0 AND b.side = 1
  WHERE a.role IS DISTINCT FROM b.role OR a.text IS DISTINCT FROM b.text GROUP BY 1),
p AS (SELECT n.*, CAST(coalesce(d.k - 1, n.least) AS INTEGER) AS prompt_turns FROM n LEFT JOIN d USING (pair_id))
SELECT p.pair_id, any_value(p.prompt_turns) AS prompt_turns,
  coalesce(string_agg(h || b, '' ORDER BY k) FILTER (side = 0 AND k <= prompt_turns), '') AS prompt,
  CASE WHEN any_value(nc) > 0 THEN coalesce(string_agg(h || b, '' ORDER BY k) FILTER (side = 0 AND k > prompt_turns), '') END AS chosen,
  CASE WHEN any_value(nc) > 0 THEN coalesce(string_agg(length(h) || ':0,' || length(b) || CASE WHEN role = 'assistant' THEN ':1' ELSE ':0' END, ',' ORDER BY k) FILTER (side = 0 AND k > prompt_turns), '') END AS chosen_runs,
  CASE WHEN any_value(nr) > 0 THEN coalesce(string_agg(h || b, '' ORDER BY k) FILTER (side = 1 AND k > prompt_turns), '') END AS rejected,
  CASE WHEN any_value(nr) > 0 THEN coalesce(string_agg(length(h) || ':0,' || length(b) || CASE WHEN role = 'assistant' THEN ':1' ELSE ':0' END, ',' ORDER BY k) FILTER (side = 1 AND k > prompt_turns), '') END AS rejected_runs
FROM p JOIN t USING (pair_id) GROUP BY p.pair_id
""",
    "op8_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 10
""",
    # crc32 bit by bit: a byte comes in with the first of its eight steps.
    "op11_spelling": r"""
WITH RECURSIVE
a AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
b AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS s, run, count(*) AS n FROM a WHERE length(run) >= 6 GROUP BY ALL),
c AS (
  SELECT run, n, flatten(list_transform(string_split(s, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [192 + unicode(x) // 64, 128 + unicode(x) % 64] END)) AS bytes FROM b),
d AS (
  SELECT run, n, xor(4294967295, list_reduce(flatten(list_transform(bytes, lambda x: [x, 0, 0, 0, 0, 0, 0, 0])),
    lambda h, x: xor(xor(h, x) >> 1, 3988292384 * (xor(h, x) & 1)), 4294967295::BIGINT)) AS h FROM c),
e AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, 2 + h % length(run)) ELSE run END AS word, n FROM d),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM e WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
i AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
cut AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM i),
holes AS (SELECT word, n, i, substr(word, 1, i - 1) AS h, substr(word, i + 1) AS t FROM i),
near AS (
  SELECT x.word, x.n, y.word AS near, y.n AS near_n FROM holes x JOIN holes y ON x.i = y.i AND x.h = y.h AND x.t = y.t AND x.word <> y.word
  UNION ALL SELECT x.word, x.n, y.word, y.n FROM cut x JOIN w y ON x.rest = y.word
  UNION ALL SELECT y.word, y.n, x.word, x.n FROM cut x JOIN w y ON x.rest = y.word),
best AS (SELECT word, n, near AS form, near_n AS form_n, count(*) OVER (PARTITION BY word) AS n_near FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
f AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form, CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n FROM w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root, 0 AS k FROM f UNION ALL SELECT c.word, f.form, k + 1 FROM chain c JOIN f ON c.root = f.word WHERE f.form IS NOT NULL),
last AS (SELECT word, arg_max(root, k) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN last USING (word)
""",
    "op12_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first IS DISTINCT FROM page_id AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM f
""",
    "op13_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT doc, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS whole FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
v AS (SELECT lang, count(*) AS v, sum(whole) AS whole_n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
n AS (SELECT lang, source, sum(n) AS total FROM c JOIN kept USING (lang, term) GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(n.total, 0) + v) AS BIGINT) AS p,
    CAST(1 + (1000000000::HUGEINT * (whole + 1)) // (whole_n + v) AS BIGINT) AS q
  FROM g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN n USING (lang, source) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, b.source AS item FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
u AS (
  SELECT lang, source, 'pair' AS part, item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM every LEFT JOIN pairs USING (lang, source, item)
  UNION ALL SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // q AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM u
QUALIFY part = 'pair' OR rank <= 200
""",
}

"""Queries over texts: normal forms, groups, families, contradictions, redaction."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.functions import text as tx
from spanloom.operators import records, similarity
from spanloom.plans.registry import query, table

FAMILIES = [("pad", "\\|"), ("code", "[{};]"), ("contact", "@"), ("numbers", "[0-9]{4,}"), ("question", "\\?")]
STOPS = "[" + ", ".join(f"'{w}'" for w in tx.STOP_WORDS) + "]"
PLAIN = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"


def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@query("""SELECT doc_id, md5(lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))) AS norm_key, length(lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))) AS norm_chars FROM documents""")
def text_normalise(spark, sf_dir):
    n = tx.norm(F.col("text"))
    return docs(spark, sf_dir).select("doc_id", F.md5(n).alias("norm_key"), F.length(n).alias("norm_chars"))


@query("SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY md5(text)")
def exact_dedup(spark, sf_dir):
    return docs(spark, sf_dir).groupBy(F.md5("text").alias("k")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).drop("k")


@query(f"""SELECT doc_id, array_to_string(list_sort(list_filter(list_distinct(string_split({PLAIN.format("text")}, ' ')), lambda w: w <> '' AND NOT list_contains({STOPS}, w))), ' ') AS words FROM documents""")
def content_words(spark, sf_dir):
    """The content words of each document in order."""
    return docs(spark, sf_dir).select("doc_id", F.array_join(tx.content_words(F.col("text")), " ").alias("words"))


TURN_SETS = "WITH s AS (SELECT conv_id * 100 + turn AS id, list_sort(list_filter(list_distinct(string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ')), lambda w: w <> '')) AS t FROM conversations)"


@query(TURN_SETS + """, g AS (SELECT t, min(id) AS g FROM s WHERE len(t) > 0 GROUP BY 1)
SELECT a.g AS a, b.g AS b, round(len(list_intersect(a.t, b.t)) / (len(a.t) + len(b.t) - len(list_intersect(a.t, b.t))), 9) AS jaccard FROM g a JOIN g b ON a.g < b.g
WHERE len(list_intersect(a.t, b.t)) / (len(a.t) + len(b.t) - len(list_intersect(a.t, b.t))) >= 0.5""")
def jaccard_pairs(spark, sf_dir):
    """Pairs of different word sets of turns that are at least half alike, exactly."""
    d = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("id"), tx.word_list(F.col("text")).alias("t"))
    return similarity.set_pairs(d, "id", "t", 0.5).withColumn("jaccard", F.round("jaccard", 9))


@query(TURN_SETS + """
SELECT id, min(id) OVER (PARTITION BY t) AS "group" FROM s""")
def equal_set_groups(spark, sf_dir):
    """Turns grouped with those of the same word set (similarity 1)."""
    d = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("id"), tx.word_list(F.col("text")).alias("t"))
    return similarity.set_groups(d, "id", "t", 1.0)


@query("""WITH n AS (SELECT p_name, count(*) AS used, array_to_string(list_sort(list_filter(string_split(trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: w <> '')), ' ') AS bag FROM part GROUP BY 1)
SELECT p_name, used, first_value(p_name) OVER (PARTITION BY bag ORDER BY used DESC, p_name) AS canonical FROM n""")
def word_bag_groups(spark, sf_dir):
    """Names with the same words in another order share their most used form."""
    bag = F.array_join(F.array_sort(tx.word_list(F.col("p_name"))), " ")
    names = table(spark, sf_dir, "part").groupBy("p_name").agg(F.count("*").alias("used")).withColumn("bag", bag)
    return similarity.canonical(names, "bag", "p_name", "used").select("p_name", "used", "canonical")


@query("""WITH n AS (SELECT p_type AS name, count(*) AS used FROM part GROUP BY 1),
w AS (SELECT name, used, unnest(list_distinct(string_split(lower(name), ' '))) AS w, list_distinct(list_transform(range(1, greatest(length(name) - 1, 2)), lambda i: substr(lower(name), i, 3))) AS g FROM n),
m AS (SELECT DISTINCT a.name AS a, b.name AS b, b.used AS ub, len(list_intersect(a.g, b.g)) / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))) AS j FROM w a JOIN w b ON a.w = b.w AND b.used > a.used AND a.name <> b.name),
r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY j DESC, ub DESC, b) AS rank FROM m)
SELECT a, b, round(j, 9) AS jaccard, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 8""")
def like_names(spark, sf_dir):
    names = table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("name")).agg(F.count("*").alias("used"))
    names = names.withColumns({"grams": tx.trigrams(F.col("name")), "words": F.array_distinct(tx.word_list(F.col("name")))})
    return similarity.like_names(names, "name", "used", "grams", "words").withColumn("jaccard", F.round("jaccard", 9))


@query("""SELECT CASE WHEN regexp_matches(text, '\\|') THEN 'pad' WHEN regexp_matches(text, '[{};]') THEN 'code' WHEN regexp_matches(text, '@') THEN 'contact' WHEN regexp_matches(text, '[0-9]{4,}') THEN 'numbers' WHEN regexp_matches(text, '\\?') THEN 'question' ELSE 'other' END AS family,
  count(*) AS n, sum(n_chars) AS chars FROM documents GROUP BY 1""")
def rule_family_counts(spark, sf_dir):
    d = records.families(docs(spark, sf_dir), F.col("text"), FAMILIES)
    return d.groupBy("family").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("""SELECT source, count(*) AS n, round(1000 * sum(length(text) - length(replace(text, '.', ''))) / sum(length(text)), 6) AS stops_per_1k, round(quantile_cont(length(text), 0.5), 3) AS median_chars FROM documents GROUP BY 1""")
def density_per_1k_chars(spark, sf_dir):
    stops = F.length("text") - F.length(F.replace("text", F.lit("."), F.lit("")))
    return docs(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n"), F.round(1000 * F.sum(stops) / F.sum(F.length("text")), 6).alias("stops_per_1k"), F.round(F.percentile(F.length("text"), 0.5), 3).alias("median_chars"))


@query("""SELECT doc_id, array_to_string(list_filter([CASE WHEN quality = 1 AND toxic = 1 THEN 'good_but_toxic' END, CASE WHEN quality = 0 AND n_chars > 5000 THEN 'poor_but_long' END, CASE WHEN n_chars <> length(text) THEN 'wrong_length' END], lambda x: x IS NOT NULL), ',') AS contradictions
FROM labels JOIN documents USING (doc_id) WHERE (quality = 1 AND toxic = 1) OR (quality = 0 AND n_chars > 5000) OR n_chars <> length(text)""")
def contradiction_rules(spark, sf_dir):
    d = table(spark, sf_dir, "labels").join(docs(spark, sf_dir), "doc_id")
    found = records.departures([
        ("quality", "good_but_toxic", (F.col("quality") == 1) & (F.col("toxic") == 1), F.col("quality")),
        ("quality", "poor_but_long", (F.col("quality") == 0) & (F.col("n_chars") > 5000), F.col("n_chars")),
        ("n_chars", "wrong_length", F.col("n_chars") != F.length("text"), F.col("n_chars")),
    ])
    d = d.withColumn("d", found).where(F.size("d") > 0)
    return d.select("doc_id", F.array_join(F.transform("d", lambda x: x["rule"]), ",").alias("contradictions"))


@query("""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}', '[email]', 'g'), '(?i)bearer\\s+[A-Za-z0-9._-]+', '[token]', 'g'), '[A-Za-z0-9]{20,}', '[key]', 'g')) AS masked FROM documents""")
def redact_values(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.md5(tx.mask_private(F.col("text"))).alias("masked"))


@query("""SELECT source, lang, count(*) AS n, count(DISTINCT md5(text)) AS texts, round(avg(quality), 6) AS quality, sum(toxic) AS toxic FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1, 2""")
def source_language_summary(spark, sf_dir):
    d = docs(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return d.groupBy("source", "lang").agg(F.count("*").alias("n"), F.countDistinct(F.md5("text")).alias("texts"), F.round(F.avg("quality"), 6).alias("quality"), F.sum("toxic").alias("toxic"))


@query("""SELECT item_id, CASE WHEN regexp_matches(text, '^T') THEN 'starts_t' WHEN regexp_matches(text, 'tion') THEN 'has_tion' END AS "case" FROM benchmark""")
def case_match(spark, sf_dir):
    """The first pattern of a list that an item matches, null if none."""
    d = table(spark, sf_dir, "benchmark")
    found = records.families(d, F.col("text"), [("starts_t", "^T"), ("has_tion", "tion")], "case")
    return found.select("item_id", F.nullif("case", F.lit("other")).alias("case"))


@query("""WITH w AS (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS w FROM conversations)
SELECT conv_id, turn, count(*) AS words, count(*) FILTER (regexp_matches(w, '^[A-Z]')) AS capitals, round(avg(length(w)), 6) AS mean_length FROM w GROUP BY 1, 2""")
def turn_words(spark, sf_dir):
    d = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.explode(F.split("text", " ")).alias("w"))
    return d.groupBy("conv_id", "turn").agg(F.count("*").alias("words"), F.count_if(F.col("w").rlike("^[A-Z]")).alias("capitals"), F.round(F.avg(F.length("w")), 6).alias("mean_length"))


@query("""WITH n AS (SELECT p_partkey, p_name, p_type, list_filter(string_split(trim(regexp_replace(lower(p_name || ' boxes of ' || p_type || 's'), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: w <> '') AS w FROM part)
SELECT p_partkey, array_to_string(list_sort(list_transform(w, lambda x: CASE WHEN length(x) <= 3 THEN x WHEN regexp_matches(x, 'ies$') THEN regexp_replace(x, 'ies$', 'y') WHEN regexp_matches(x, '(ss|us|is)$') THEN x WHEN regexp_matches(x, '(ches|shes|xes|sses|zes)$') THEN regexp_replace(x, 'es$', '') WHEN regexp_matches(x, 's$') THEN regexp_replace(x, 's$', '') ELSE x END)), ' ') AS bag,
  CASE len(w) WHEN 1 THEN w[1] ELSE array_to_string(w[1:len(w) - 1], ', ') || ' and ' || w[len(w)] END AS listed,
  sha256(trim(regexp_replace(lower(p_name), '\\s+', ' ', 'g'))) AS key, sha256(length(p_name) || ':' || p_name || length(p_type) || ':' || p_type) AS print,
  CASE WHEN p_type IN ('SMALL', 'LARGE') THEN p_type ELSE 'unclear' END AS known, list_has_any(w, ['red', 'hot']) AS warm FROM n""")
def name_keys(spark, sf_dir):
    """Word bags, lists, keys and fingerprints of part names."""
    name = F.concat("p_name", F.lit(" boxes of "), "p_type", F.lit("s"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", tx.word_bag(name).alias("bag"), tx.and_list(tx.word_list(name)).alias("listed"), tx.prompt_key(F.col("p_name")).alias("key"),
        tx.fingerprint(F.col("p_name"), F.col("p_type")).alias("print"), tx.one_of(F.col("p_type"), ["SMALL", "LARGE"]).alias("known"), tx.has_word(F.col("p_name"), ["red", "hot"]).alias("warm"),
    )


@query("""SELECT c_custkey, CAST(regexp_extract(c_name, '([0-9]+)$', 1) AS BIGINT) AS number, coalesce(nullif(trim(CASE WHEN c_custkey % 3 = 0 THEN '  ' ELSE c_mktsegment END), ''), c_name) AS shown,
  regexp_matches(c_name || md5(c_name), '[A-Za-z0-9]{20,}') AS keyed FROM customer""")
def name_parts(spark, sf_dir):
    blank = F.when(F.col("c_custkey") % 3 == 0, "  ").otherwise(F.col("c_mktsegment"))
    keyed = tx.key_material(F.concat("c_name", F.md5("c_name")))
    return table(spark, sf_dir, "customer").select("c_custkey", tx.trailing_number(F.col("c_name")).alias("number"), tx.first_text(blank, F.col("c_name")).alias("shown"), keyed.alias("keyed"))


@query("""WITH n AS (SELECT DISTINCT p_name, list_distinct(string_split(p_name, ' ')) AS w FROM part), t AS (SELECT DISTINCT p_type, list_distinct(string_split(lower(p_type), ' ')) AS w FROM part),
a AS (SELECT p_name AS name, w FROM n UNION ALL SELECT 'x ' || p_name, list_distinct(list_append(w, 'x')) FROM n)
SELECT a.name AS a, b.name AS b, len(a.w) = len(b.w) OR len(list_intersect(a.w, b.w)) < least(len(a.w), len(b.w)) AS allowed FROM a JOIN n ON a.name = n.p_name JOIN a b ON b.name = 'x ' || a.name""")
def merges_allowed(spark, sf_dir):
    """A name and the same with a word more: one set of words holds the other, so no merge."""
    n = table(spark, sf_dir, "part").select("p_name").distinct()
    d = n.select(F.col("p_name").alias("a"), F.concat(F.lit("x "), "p_name").alias("b"))
    d = d.withColumns({"wa": F.array_distinct(F.split("a", " ")), "wb": F.array_distinct(F.split("b", " "))})
    return d.select("a", "b", similarity.merge_allowed("wa", "wb").alias("allowed"))

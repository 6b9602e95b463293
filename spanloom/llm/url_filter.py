"""URL filter: ordered host/path rules first, else a character model ratio.

Two variable-order Markov models (orders 0 to 3, each order smoothed by the one
below) are counted from accepted and rejected URLs.  A URL's score is the mean
log-likelihood difference per character; the threshold is calibrated on a fold
of labelled URLs that was not counted.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spanloom.llm.words import free, quoted
from spanloom.session import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: 26 letters, one digit, these marks, "~" for anything else, "^" and "$": 41 symbols,
#: so at most 41**4 four-grams however many URLs there are.
MARKS = "/:.-_?=&#%+"
ORDER, STRENGTH = 3, 4.0
#: A URL with this share of all rows or more is looked up by broadcast.
HOT_SHARE = 1e-4


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.when(F.contains(url, F.lit("://")), F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise("")
    return F.coalesce(F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.when(F.contains(url, F.lit("://")), F.regexp_extract(url, "^[\\s\\S]*?://[^/?#]*([^?#]*)", 1)), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest fitting rule's text; rules: (verdict, "host/path")."""
    fits = []
    for _, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        h, slash, p = rule.partition("/")
        fits.append(F.when(((host == h) | host.endswith("." + h)) & path.startswith(slash + p), F.lit(rule)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def symbols(url: Column) -> Column:
    """The URL in the model's alphabet, with three starts and an end."""
    text = F.regexp_replace(F.translate(F.coalesce(url, F.lit("")), UPPER, LOWER), "[0-9]", "0")
    return F.concat(F.lit("^" * ORDER), F.regexp_replace(text, "[^a-z0" + MARKS.replace("-", "\\-") + "]", "~"), F.lit("$"))


def grams(df: DataFrame) -> DataFrame:
    """One row per character of column ``s``: the character after its context."""
    return df.select("*", F.explode(F.sequence(F.lit(1), F.length("s") - ORDER)).alias("i")).withColumn("g", F.substring(F.col("s"), F.col("i"), F.lit(ORDER + 1))).drop("i", "s")


def packed(gram: Column) -> Column:
    """A gram of four ASCII signs as a long, which joins keep without objects."""
    return F.conv(F.hex(gram), 16, 10).cast("long")


def ratio_table(counts: DataFrame) -> DataFrame:
    """g, llr: log ratio of the two smoothed probabilities of a four-gram's last
    character.  counts: g, a, r (0 where only unlabelled URLs have it)."""
    p = None
    for k in range(ORDER + 1):
        level = counts.groupBy(F.substring("g", ORDER + 1 - k, k + 1).alias("t")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        under = level.groupBy(F.substring("t", 1, k).alias("h")).agg(F.sum("a").alias("na"), F.sum("r").alias("nr"))
        level = level.withColumn("h", F.substring("t", 1, k)).join(under, "h")
        if p is None:
            level = level.withColumns({"qa": F.lit(1 / 41), "qr": F.lit(1 / 41)})
        else:
            level = level.withColumn("u", F.substring("t", 2, k)).join(p, "u")
        p = level.select(F.col("t").alias("u"), *(((F.col(c) + STRENGTH * F.col("q" + c)) / (F.col("n" + c) + STRENGTH)).alias("q" + c) for c in "ar"))
    return p.select(F.col("u").alias("g"), (F.log("qa") - F.log("qr")).alias("llr"))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], url: str = "url", label: Column | None = None) -> DataFrame:
    """``pages`` plus host, path, rule, score and verdict ("allow" or "block").

    ``label`` says which URLs teach the models: "allow", "block" or null; by
    default the verdicts of the rules.  Where no rule fits, a URL is blocked if
    its score is under the calibrated threshold; a null URL has no score and is
    allowed, and so is everything where a class has no calibration URL.  A URL
    that is labelled both ways teaches as blocked.  Equal URLs get equal verdicts; repeated rows stay.  Columns of ``pages`` with the
    names added are replaced.
    """
    added = ["host", "path", "rule", "score", "verdict"]
    verdict_of = {r: v for v, r in rules}
    base = pages.drop(*added).withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    base = base.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    ruled = F.coalesce(*(F.when(F.col("rule") == r, F.lit(v)) for r, v in verdict_of.items()), F.lit(None).cast("string"))
    label = ruled if label is None else label
    # One row per URL: a URL that fills a third of the table is counted with weight, not repeated.
    urls = base.select(F.col(url).alias("u"), label.alias("label")).where("u is not null").groupBy("u").agg(F.count("*").alias("w"), F.max("label").alias("label"))
    urls = stored(urls.withColumn("held", F.substring(F.md5("u"), 1, 1).isin("0", "1", "2")), "urls").withColumn("s", symbols(F.col("u")))
    taught = lambda c: F.sum(F.when((F.col("label") == c) & ~F.col("held"), F.col("w")).otherwise(0)).cast("double")
    table = ratio_table(grams(urls.select("s", "w", "label", "held")).groupBy("g").agg(taught("allow").alias("a"), taught("block").alias("r")))
    table = stored(table.select(packed(F.col("g")).alias("g"), "llr"), "url-ratios")
    # At most 41**4 grams however many URLs: the table is broadcast, and a URL's characters stay where the URL is.
    priced = grams(urls).withColumn("g", packed(F.col("g"))).join(F.broadcast(table), "g")
    scores = stored(priced.groupBy("u", "label", "held", "w").agg(F.avg("llr").alias("score")), "url-scores")
    fit = {r["label"]: r for r in scores.where("held and label is not null").groupBy("label").agg(F.avg("score").alias("m"), F.stddev_pop("score").alias("sd")).collect()}
    least = None
    if "allow" in fit and "block" in fit:
        a, r = fit["allow"], fit["block"]
        spread = a["sd"] + r["sd"]
        least = (a["m"] * r["sd"] + r["m"] * a["sd"]) / spread if spread else (a["m"] + r["m"]) / 2
    out = with_scores(base, url, scores)
    method = F.when(F.col("score") < least, "block").otherwise("allow") if least is not None else F.lit("allow")
    return out.withColumn("verdict", F.coalesce(ruled, method))


def with_scores(base: DataFrame, url: str, scores: DataFrame) -> DataFrame:
    """``base`` with each URL's score.  Hot URLs (at most 1 / HOT_SHARE of them) are
    looked up by broadcast; their rows and those without a URL go on under keys that
    match nothing, so that they spread."""
    total = scores.agg(F.sum("w")).first()[0] or 0
    hot_url, hot_score, key = free(base, "_hot"), free(base, "_hot_score"), free(base, "_key")
    hot = scores.where(F.col("w") >= total * HOT_SHARE).select(F.col("u").alias(hot_url), F.col("score").alias(hot_score))
    rest = scores.where(F.col("w") < total * HOT_SHARE).select(F.col("u").alias(key), "score")
    alone = F.concat(F.lit("\0"), F.monotonically_increasing_id().cast("string"))
    met = base.join(F.broadcast(hot), F.col(url) == F.col(hot_url), "left")
    keyed = met.withColumn(key, F.when(F.col(url).isNotNull() & F.col(hot_url).isNull(), F.col(url)).otherwise(alone))
    return keyed.join(rest, key, "left").withColumn("score", F.coalesce("score", hot_score)).select(*map(quoted, base.columns), "score")

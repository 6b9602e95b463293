"""Language identification by Bayesian fusion of four kinds of evidence.

* Text: byte-bigram likelihoods of each language, and of a uniform model for
  what is no language, fitted on a bounded sample of labelled rows.
* Declared language (markup or catalogue): P(declared | language).
* Address suffix: P(language | suffix), smoothed towards the whole.
* Host: P(language | host), smoothed towards its suffix, without the row's own
  share.
The last three come from grouped sums of the text posteriors of all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from spanloom.llm.tokens import groups
from spanloom.llm.words import quoted
from spanloom.session import stored

SAMPLE_ROWS = 400
#: Bound of the model: 256 KB for each language in every worker.
MOST_LANGUAGES = 500
EVIDENCE = 60.0
STRENGTH = 5.0
BROADCAST_ROWS = 200_000
#: Symbols of text as the uniform model sees them (two bytes of any kind).
FLOOR = 1e-4


def bigrams(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8).astype(np.uint16)
    return b[:-1] << np.uint16(8) | b[1:]


def squeezed(text: str | None) -> bytes:
    """Lower-cased words with single blanks around them; marks and digits stay
    as they are, so that lists of numbers look like no language."""
    return b" " + b" ".join((text or "").lower().encode().split()) + b" "


def gram_counts(batches):
    """language, bigram and its number over a task's texts; 64 languages are held at once."""
    out: dict = {}

    def held(kind):
        for name, n in out.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), kind), pa.array(at, pa.int64()), pa.array(n[at])], ["_l", "_g", "_n"])
        out.clear()

    for b in batches:
        for name, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if name not in out:
                if len(out) == 64:
                    yield from held(b.schema.field(0).type)
                out[name] = np.zeros(1 << 16, np.int64)
            out[name] += np.bincount(bigrams(squeezed(t)), minlength=1 << 16)
    if out:
        yield from held(b.schema.field(0).type)


def fit(labelled: DataFrame, text: str, language: str, per_language: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """Every language that labels a text, and log P(second byte | first byte) for
    each, from at most ``per_language`` distinct texts of each, those of the
    least hashes; each gives its first 20,000 characters at most.  More than
    MOST_LANGUAGES languages are a ValueError."""
    rows = labelled.where(F.col(language).isNotNull() & F.col(text).isNotNull()).select(F.col(language).alias("_l"), F.xxhash64(text).alias("_h"), F.substring(text, 1, 20000).alias("_x"))
    place = F.row_number().over(Window.partitionBy("_l").orderBy("_h"))
    chosen = stored(rows.select("_l", "_h").distinct().withColumn("_k", place).where(F.col("_k") <= per_language).drop("_k"), "language-sample")
    names = sorted(r[0] for r in chosen.select("_l").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages in {language}; each takes 256 KB of every worker's model")
    texts = rows.join(F.broadcast(chosen), ["_l", "_h"]).groupBy("_l", "_h").agg(F.min("_x").alias("_x")).select("_l", "_x")
    grams = texts.mapInArrow(gram_counts, f"_l {texts.schema['_l'].dataType.simpleString()}, _g long, _n long").groupBy("_l", "_g").agg(F.sum("_n").alias("_n")).toArrow()
    out, at = np.zeros((len(names), 1 << 16), np.float32), {name: k for k, name in enumerate(names)}
    out[[at[x] for x in grams.column("_l").to_pylist()], grams.column("_g").to_numpy()] = grams.column("_n").to_numpy()
    n = out.reshape(-1, 256, 256)
    n += FLOOR * 256 / 256
    n /= n.sum(2, keepdims=True)
    n *= 0.98
    n += 0.02 / 256
    return names, np.log(out, out=out)


def text_posteriors(df: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """The columns of ``df`` but its last, a text, plus n (bytes of evidence) and t:
    log-likelihoods of each language, scaled to at most EVIDENCE bigrams, and last
    that of no language."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        names, table = shared.value
        # A uniform choice of 48 signs after each: what beats it has the shape of a language.
        table = np.vstack([table, np.full((1, 1 << 16), -np.log(48), np.float32)]).T.copy()
        for b in batches:
            out, sizes = [], []
            for some in groups(b.column(b.num_columns - 1).to_pylist(), 1 << 16):
                for t in some:
                    g = bigrams(squeezed(t))
                    total = np.zeros(table.shape[1])
                    for at in range(0, len(g) if len(g) > 1 else 0, 1 << 20):
                        total += table[g[at : at + (1 << 20)]].sum(0, dtype=np.float64)
                    out.append(total * min(1.0, EVIDENCE / max(1, len(g))))
                    sizes.append(len(g) if len(g) > 1 else 0)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sizes, pa.int64()), pa.array(out, pa.list_(pa.float64()))], [*b.schema.names[:-1], "n", "t"])

    added = T.StructType([T.StructField("n", T.LongType()), T.StructField("t", T.ArrayType(T.DoubleType()))])
    return df.mapInArrow(run, T.StructType([*df.schema.fields[:-1], *added.fields]))


def softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, y: a + y))


def identify(df: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text", declared: Column | None = None, suffix: Column | None = None, host: Column | None = None, least: float = 0.5, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``df`` (default: all) plus language, confidence, text_language
    and accepted.

    Evidence columns may be left out, and nulls in them are no evidence.  A row
    is accepted where its text is likelier in the language than under the
    uniform model and its confidence is ``least`` or more; null, empty and
    blank texts are never accepted and have a null text_language.  With no
    model language nothing is accepted.  Equal rows get equal results; rows stay
    as they are, and columns of ``df`` with the added names are replaced.  Each
    text is scored once: its posteriors are written with the columns asked for.
    """
    names, _ = model
    added = ["language", "confidence", "text_language", "accepted"]
    kept = [c for c in (df.columns if columns is None else columns) if c not in added]
    if not names:
        none = {"language": F.lit(None).cast("string"), "confidence": F.lit(0.0), "text_language": F.lit(None).cast("string"), "accepted": F.lit(False)}
        return df.select(*map(quoted, kept)).withColumns(none)
    size = len(names)
    null = F.lit(None).cast("string")
    # The caller's columns travel as one, so that no name can clash.
    row = F.struct(*(F.col(quoted(c)) for c in kept)) if kept else F.struct(F.lit(0).alias("none"))
    base = df.select(row.alias("row"), (null if declared is None else declared).alias("d"), (null if suffix is None else suffix).alias("s"), (null if host is None else host).alias("h"), F.col(text).alias("text"))
    scored = stored(text_posteriors(base, model), "language-posteriors").withColumn("p", softmax(F.slice("t", 1, size)))
    sums = [F.sum(F.when(F.col("n") > 0, F.col("p")[k]).otherwise(0.0)).alias(f"p{k}") for k in range(size)]
    table = stored(scored.groupBy("d", "s", "h").agg(*sums), "language-sums")
    again = lambda *keys: table.groupBy(*keys).agg(*(F.sum(f"p{k}").alias(f"p{k}") for k in range(size)))
    whole = [x or 0.0 for x in again().first()]
    overall = [(x + 1.0) / (sum(whole) + size) for x in whole]
    counts = F.array(*(F.col(f"p{k}") for k in range(size)))
    # A declared language's likelihood under each language, smoothed by one row of each kind.
    spoken = again("d").where("d is not null").select("d", F.array(*(F.log((F.col(f"p{k}") + 1.0) / F.lit(whole[k] + 2.0)) for k in range(size))).alias("ld"))
    of_suffix = again("s").where("s is not null").select("s", counts.alias("cs"))
    of_host = again("s", "h").where("h is not null").select(F.col("s").alias("hs"), F.col("h").alias("hh"), counts.alias("ch"))

    def joined(left: DataFrame, right: DataFrame, on) -> DataFrame:
        right = stored(right, "language-priors")
        return left.join(F.broadcast(right) if right.count() <= BROADCAST_ROWS else right, on, "left")

    scored = joined(scored, spoken, "d")
    scored = joined(scored, of_suffix, "s")
    scored = joined(scored, of_host, (F.col("h") == F.col("hh")) & F.col("s").eqNullSafe(F.col("hs")))
    own = F.when(F.col("n") > 0, F.col("p")).otherwise(F.array_repeat(F.lit(0.0), size))

    def prior(counted: Column, above: Column) -> Column:
        """Counts of other rows with STRENGTH rows' worth of what stands above."""
        others = F.zip_with(counted, own, lambda c, o: F.greatest(c - o, F.lit(0.0)))
        total = F.aggregate(others, F.lit(0.0), lambda a, x: a + x)
        return F.coalesce(F.zip_with(others, above, lambda c, p: (c + p * STRENGTH) / (total + STRENGTH)), above)

    scored = scored.withColumn("ps", prior(F.col("cs"), F.array(*map(F.lit, overall)))).withColumn("ph", prior(F.col("ch"), F.col("ps")))
    logs = F.zip_with(F.zip_with(F.slice("t", 1, size), F.col("ph"), lambda t, p: t + F.log(p)), F.coalesce("ld", F.array_repeat(F.lit(0.0), size)), lambda a, b: a + b)
    scored = scored.withColumn("f", softmax(logs))
    place = lambda c: F.array_position(c, F.array_max(c)).cast("int")
    named = F.array(*map(F.lit, names))
    best = place(F.col("f"))
    found = {
        "language": F.element_at(named, best),
        "confidence": F.array_max("f"),
        "text_language": F.when(F.col("n") > 0, F.element_at(named, place(F.slice("t", 1, size)))),
        "accepted": (F.col("n") > 0) & (F.element_at("t", best) > F.element_at("t", size + 1)) & (F.array_max("f") >= least),
    }
    return scored.select(*(F.col("row").getField(c).alias(c) for c in kept), *(x.alias(c) for c, x in found.items()))


def page_text(html: Column) -> Column:
    """What a page shows: scripts, styles, comments and tags taken out."""
    bare = F.regexp_replace(html, "(?is)<(script|style)\\b.*?</\\1>|<!--.*?-->", " ")
    return F.regexp_replace(F.regexp_replace(bare, "(?s)<[^>]*>", " "), "&[a-zA-Z#0-9]+;", " ")


def page_declared(html: Column) -> Column:
    """The two-letter language that the html element declares, else null."""
    return F.nullif(F.lower(F.regexp_extract(html, "(?is)<html\\b[^>]*\\blang\\s*=\\s*[\"']?([a-z]{2})\\b", 1)), F.lit(""))

"""How the sources of a language differ: term by term and against each other.

Terms are counted where the documents lie and meet in shards by a hash of language
and term.  DuckDB counts each shard, keeps the terms of enough documents, and in a
second pass over the kept terms finds each group's own leading terms and the part of
every pair's sum that needs both counts of a term.  Spark merges sums and rankings.

A pair's sum runs over all kept terms of its language, but most are missing from one
of the two groups or from both.  With z a group's p of a count of 0 and f(p, q) =
floor((p - q)^2 / q), the sum of f over all V terms is

    V f(z, z')
    + sum over terms of the group:       f(p, z') - f(z, z')
    + sum over terms of the other:       f(z, q) - f(z, z')
    + sum over terms of both: f(p, q) - f(p, z') - f(z, q) + f(z, z')

The shards give the last line.  The two before it need only how many terms of a group
have each count, so no term meets a group that lacks it.  All numbers are integers.
"""

from __future__ import annotations

from collections import Counter

import duckdb
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from spanloom.session import stored

#: Every byte of UTF-8 as it counts: A-Z lower-cased, ASCII letters and all that isn't ASCII kept, the rest blank.
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
#: Bytes of a text that are split at once.
PIECE = 1 << 20
SCALE = 1_000_000_000
#: Distinct (language, source, term) that a task holds before it hands its counts on.
HELD = 400_000
#: Kept terms that are laid before DuckDB at once.
ROWS = 100_000
#: More groups than this are joined by Spark and not sent to every task (some 100 bytes each).
GROUPS = 100_000
MEMORY = "256MB"
WHOLE = "decimal(38,0)"

#: A shard's counts: per kept term its groups and their counts.
COUNT_SQL = """
WITH c AS (SELECT lang, term, source, sum(n)::BIGINT AS n, sum(d)::BIGINT AS d FROM shard GROUP BY ALL)
SELECT lang, term, list(source ORDER BY source) AS sources, list(n ORDER BY source) AS counts FROM c GROUP BY lang, term HAVING sum(d) >= ?
"""
#: Kept terms, one row per group: its count, its p, its p of a count of 0, its language's p.
ROWS_SQL = """
CREATE OR REPLACE TABLE r AS
WITH k AS (SELECT lang, term, list_sum(counts) AS total, unnest(sources) AS source, unnest(counts) AS n FROM kept)
SELECT lang, term, source, n, p_of(n, g.total, v) AS p, p_of(0, g.total, v) AS z, p_of(k.total, whole, v) AS q FROM k JOIN g USING (lang, source)
"""
FLAT_ROWS_SQL = """
CREATE OR REPLACE TABLE r AS
SELECT lang, term, source, n, p_of(n, group_total, v) AS p, p_of(0, group_total, v) AS z, p_of(sum(n) OVER (PARTITION BY lang, term), whole, v) AS q FROM kept
"""
PARTS_SQL = """
SELECT 'term' AS part, lang, source, term AS item, 0::BIGINT AS n, f_of(p, q)::DECIMAL(38,0) AS value FROM r WHERE p > q
QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY f_of(p, q) DESC, term) <= ?
UNION ALL
SELECT 'pair', lang, a.source, b.source, 0, sum(f_of(a.p, b.p) - f_of(a.p, b.z) - f_of(a.z, b.p) + f_of(a.z, b.z))::DECIMAL(38,0) FROM r a JOIN r b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL
UNION ALL
SELECT 'count', lang, source, NULL, n, count(*)::DECIMAL(38,0) FROM r GROUP BY ALL
"""
PART = "part string, lang string, source string, item string, n long, value decimal(38,0)"


def connection() -> duckdb.DuckDBPyConnection:
    con = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "preserve_insertion_order": False})
    con.execute(f"CREATE MACRO p_of(n, total, v) AS (1 + ({SCALE}::HUGEINT * (n + 1)) // (total + v))::BIGINT")
    con.execute("CREATE MACRO f_of(p, q) AS ((p - q) * (p - q)) // q")
    return con


def counted(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """lang, source, term, n and d (documents) as each task has counted them.  Texts are
    bytes: what parts terms is ASCII, so one translation and one split find them."""
    fields = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("d", pa.int64())])

    def count(batches):
        groups: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0

        def rows():
            for (l, s), (n, d) in groups.items():
                terms = pa.array(list(n), pa.binary()).cast(pa.string())
                columns = [pa.repeat(pa.scalar(x, pa.string()), len(n)) for x in (l, s)]
                yield pa.RecordBatch.from_arrays([*columns, terms, pa.array(list(n.values()), pa.int64()), pa.array(list(map(d.__getitem__, n)), pa.int64())], schema=fields)
            groups.clear()

        for b in batches:
            for t, l, s in zip(*(c.to_pylist() for c in b.columns)):
                n, d = groups.setdefault((l, s), (Counter(), Counter()))
                before, seen, at = len(n), set(), 0
                x = t.translate(TABLE)
                while at < len(x):  # a very long text is split piece by piece
                    to = x.find(b" ", at + PIECE)
                    some = x[at : to if to >= 0 else len(x)].split()
                    n.update(some)
                    seen.update(some)
                    at = to if to >= 0 else len(x)
                d.update(seen)
                held += len(n) - before
                if held > HELD:
                    yield from rows()
                    held = 0
        yield from rows()

    return docs.select(F.col(text).cast("binary"), lang, source).mapInArrow(count, "lang string, source string, term string, n long, d long")


def kept_terms(counts: DataFrame, least_docs: int) -> DataFrame:
    """lang, term, sources and counts of the terms that enough documents of the language have."""

    def count(batches):
        with connection() as con:
            con.execute("CREATE TABLE shard (lang VARCHAR, source VARCHAR, term VARCHAR, n BIGINT, d BIGINT)")
            for b in batches:
                one = pa.Table.from_batches([b])
                con.execute("INSERT INTO shard SELECT lang, source, term, n, d FROM one")
                del one
            yield from con.sql(COUNT_SQL, params=[least_docs]).to_arrow_reader(10_000)

    return counts.repartition("lang", "term").mapInArrow(count, "lang string, term string, sources array<string>, counts array<long>")


def shard_parts(kept: DataFrame, groups: DataFrame, top: int, most_groups: int) -> DataFrame:
    """Leading terms, pair sums and count frequencies (part, lang, source, item, n, value)
    of each shard.  groups: lang, source, total, whole, v."""
    few = groups.limit(most_groups + 1).count() <= most_groups
    if few:
        table = kept.sparkSession.sparkContext.broadcast(groups.toArrow())
        rows = kept.select("lang", "term", "sources", "counts")
    else:
        flat = kept.select("lang", "term", F.explode(F.arrays_zip(F.col("sources").alias("source"), F.col("counts").alias("n"))).alias("x")).select("lang", "term", "x.source", "x.n")
        rows = flat.join(groups.withColumnRenamed("total", "group_total"), ["lang", "source"]).repartition("lang", "term").sortWithinPartitions("lang", "term")

    def parts(batches):
        with connection() as con:
            if few:
                g = table.value
                con.execute("CREATE TABLE g AS SELECT * FROM g")
            for kept in chunks(batches):
                con.execute(ROWS_SQL if few else FLAT_ROWS_SQL)
                yield from con.sql(PARTS_SQL, params=[top]).to_arrow_reader(10_000)

    def chunks(batches):
        held, n = [], 0
        for b in batches:
            if not few and n >= ROWS:  # a term's rows stay together
                same = sum(1 for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if x == (held[-1].column(0)[-1].as_py(), held[-1].column(1)[-1].as_py()))
                yield pa.Table.from_batches([*held, b.slice(0, same)])
                held, n, b = [], 0, b.slice(same)
            if b.num_rows:
                held.append(b)
                n += b.num_rows
            if few and n >= ROWS:
                yield pa.Table.from_batches(held)
                held, n = [], 0
        if held:
            yield pa.Table.from_batches(held)

    return rows.mapInArrow(parts, PART)


def p_of(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + v)), exact."""
    return 1 + F.call_function("div", F.lit(SCALE).cast(WHOLE) * (n + 1).cast("decimal(20,0)"), (total + v).cast("decimal(20,0)"))


def f_of(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q).cast(WHOLE)


def pair_values(parts: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (each other source of the language) and value of every pair."""
    zeros = groups.withColumn("z", F.when(F.col("v") > 0, p_of(F.lit(0), F.col("total"), F.col("v"))))
    one = zeros.select("lang", "source", F.col("z").alias("zs"), "v")
    two = zeros.select("lang", F.col("source").alias("item"), F.col("z").alias("zi"))
    # The result has a row for every two sources of a language; so has this.
    every = one.join(two, "lang").where("source <> item").select("lang", "source", "item", F.coalesce(F.col("v").cast(WHOLE) * f_of(F.col("zs"), F.col("zi")), F.lit(0).cast(WHOLE)).alias("value"))
    often = parts.where("part = 'count'").groupBy("lang", "source", "n").agg(F.sum("value").alias("k"))
    often = stored(often.join(groups, ["lang", "source"]).select("lang", "source", "k", p_of(F.col("n"), F.col("total"), F.col("v")).alias("p"), p_of(F.lit(0), F.col("total"), F.col("v")).alias("zs")), "counts-of-terms")
    met = often.join(two, "lang").where("source <> item")
    both = met.groupBy("lang", "source", "item").agg(
        F.sum(F.col("k") * (f_of(F.col("p"), F.col("zi")) - f_of(F.col("zs"), F.col("zi")))).cast(WHOLE).alias("own"),
        F.sum(F.col("k") * (f_of(F.col("zi"), F.col("p")) - f_of(F.col("zi"), F.col("zs")))).cast(WHOLE).alias("other"),
    )
    both = stored(both, "one-sided")
    own = both.select("lang", "source", "item", F.col("own").alias("value"))
    other = both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("other").alias("value"))
    shared = parts.where("part = 'pair'").select("lang", "source", "item", "value")
    return every.unionByName(own).unionByName(other).unionByName(shared).groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))


def source_divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = 3, top: int = 200, most_groups: int = GROUPS) -> DataFrame:
    """lang, source, part, item, value and rank for every (lang, source) of ``docs``.

    Part ``pair``: every other source of the language with the sum of f over its kept
    terms (those in at least ``least_docs`` of its documents); part ``term``: the
    ``top`` terms that the source has more often than its language.  Null texts,
    languages and sources are empty; rows that repeat are documents of their own; other
    columns are not read; an empty table gives no rows.  Beyond ``most_groups`` groups
    their totals are joined to the terms; the result is the same.
    """
    read = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((text, "text"), (lang, "lang"), (source, "source"))]
    docs = docs.select(*read)
    kept = stored(kept_terms(counted(docs, "text", "lang", "source"), least_docs), "kept-terms")
    flat = kept.select("lang", F.explode(F.arrays_zip(F.col("sources").alias("source"), F.col("counts").alias("n"))).alias("x"))
    totals = flat.groupBy("lang", F.col("x.source").alias("source")).agg(F.sum("x.n").alias("total"))
    kinds = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("whole"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(kinds, "lang", "left")
    groups = stored(groups.select("lang", "source", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "whole", "v"))), "groups")
    parts = stored(shard_parts(kept, groups, top, most_groups), "shard-parts")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pair_values(parts, groups).withColumn("part", F.lit("pair")).withColumn("rank", rank)
    terms = parts.where("part = 'term'").select("lang", "source", "part", "item", F.col("value").cast("long").alias("value")).withColumn("rank", rank).where(F.col("rank") <= top)
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))

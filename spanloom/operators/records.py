"""Validation, rules and overlays on nested records, with where and why kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TIERS = ["low", "medium", "high"]


def departures(rules: list[tuple[str, str, Column, Column]]) -> Column:
    """An array of (field, rule, value) for the rules a row departs from.
    rules: (field, rule, departs, value); a null condition is no departure."""
    found = F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(f).alias("field"), F.lit(r).alias("rule"), v.cast("string").alias("value"))) for f, r, bad, v in rules))
    return F.filter(found, lambda x: x.isNotNull())


def checked_items(df: DataFrame, keys: list[str], items: str, rules) -> DataFrame:
    """One row for each element of an array column with its source row number
    (from 0) and its departures.  ``rules``: element column -> rule list."""
    long = df.select(*keys, F.posexplode(items).alias("source_row", "item"))
    return long.withColumn("departures", departures(rules(F.col("item"))))


def tier_rank(severity: Column) -> Column:
    """1, 2, 3 for a valid tier, else null: unrated is no tier."""
    return F.when(severity == "low", 1).when(severity == "medium", 2).when(severity == "high", 3)


def capped(severity: Column, cap: str) -> Column:
    """The tier, lowered to ``cap`` where above it; unrated stays unrated."""
    return F.when(tier_rank(severity) > TIERS.index(cap) + 1, F.lit(cap)).when(tier_rank(severity).isNotNull(), severity)


def apply_rules(df: DataFrame, severity: str, rules: list[tuple[str, Column, str | None]]) -> DataFrame:
    """Ordered rules (kind "cap" or "exclude", condition, tier): severity as ruled,
    given_severity as it was, excluded, and rules, the numbers of those that applied."""
    now, out, used = F.col(severity), F.lit(False), []
    for k, (kind, when, tier) in enumerate(rules):
        hit = F.coalesce(when, F.lit(False))
        used.append(F.when(hit, F.lit(k)))
        if kind == "cap":
            now = F.when(hit, capped(now, tier)).otherwise(now)
        else:
            out = out | hit
    return df.withColumns({"given_severity": F.col(severity), severity: now, "excluded": out, "rules": F.filter(F.array(*used), lambda x: x.isNotNull())})


def overlay(base: DataFrame, edits: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Edits fill fields where the base has none; conflicts lists the fields where
    both have different values (the base's stays)."""
    two = edits.select(key, *(F.col(f).alias(f"_{f}") for f in fields))
    d = base.join(two, key, "left")
    clash = F.filter(F.array(*(F.when(F.col(f).isNotNull() & F.col(f"_{f}").isNotNull() & (F.col(f) != F.col(f"_{f}")), F.lit(f)) for f in fields)), lambda x: x.isNotNull())
    d = d.withColumn("conflicts", clash)
    return d.withColumns({f: F.coalesce(f, f"_{f}") for f in fields}).drop(*(f"_{f}" for f in fields))


def families(df: DataFrame, text: Column, rules: list[tuple[str, str]], name: str = "family") -> DataFrame:
    """The first rule (family, pattern) that a text matches, in the rules' order, else "other"."""
    out = F.lit("other")
    for family, pattern in reversed(rules):
        out = F.when(F.coalesce(text.rlike(pattern), F.lit(False)), F.lit(family)).otherwise(out)
    return df.withColumn(name, out)


def changed(now: DataFrame, before: DataFrame, key: str, digest: str) -> DataFrame:
    """Rows that are new or whose digest differs: what an incremental run redoes."""
    old = before.select(key, F.col(digest).alias("_was"))
    d = now.join(old, key, "left")
    return d.withColumn("state", F.when(F.col("_was").isNull(), "new").when(F.col("_was") != F.col(digest), "changed").otherwise("same")).drop("_was")


def same_multiset(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either side without a partner on the other, with their surplus."""
    cols = a.columns
    both = a.withColumn("_n", F.lit(1)).unionByName(b.withColumn("_n", F.lit(-1)))
    return both.groupBy(*cols).agg(F.sum("_n").alias("surplus")).where("surplus <> 0")


#: A JSON text as a whole string, a stretch without brackets and quotes, or one of these signs.
TOKENS = r'"(?:[^"\\]++|\\[\s\S])*+"|[^"{}\[\]()]++|["{}\[\]()]'


def mended(text: Column) -> Column:
    """``text`` with its one closing bracket of the wrong kind put right; null where, outside
    of strings, the brackets don't pair up but for exactly one.  One pass over the
    brackets with a stack, so work is linear in the text."""
    tokens = F.regexp_extract_all(text, F.lit(TOKENS), F.lit(0))
    signs = F.filter(F.transform(tokens, lambda t, i: F.struct(t.alias("t"), i.alias("i"))), lambda x: x["t"].isin("{", "[", "}", "]", ")", '"'))
    start = F.struct(F.lit("").alias("stack"), F.lit(True).alias("ok"), F.lit(0).alias("wrong"), F.lit(-1).alias("at"), F.lit("").alias("right"))

    def step(a: Column, x: Column) -> Column:
        opens = x["t"].isin("{", "[")
        due = F.substring(a["stack"], -1, 1)
        off = ~opens & (due != x["t"])
        stack = F.when(opens, F.concat(a["stack"], F.when(x["t"] == "{", "}").otherwise("]"))).otherwise(F.substring(a["stack"], F.lit(1), F.greatest(F.length(a["stack"]) - 1, F.lit(0))))
        # A quote that stands alone begins a string without an end.
        ok = a["ok"] & (x["t"] != '"') & (opens | (F.length(a["stack"]) > 0))
        return F.struct(stack.alias("stack"), ok.alias("ok"), (a["wrong"] + off.cast("int")).alias("wrong"), F.when(off, x["i"]).otherwise(a["at"]).alias("at"), F.when(off, due).otherwise(a["right"]).alias("right"))

    end = F.aggregate(signs, start, step)
    one = end["ok"] & (end["stack"] == "") & (end["wrong"] == 1)
    return F.when(one, F.array_join(F.concat(F.slice(tokens, F.lit(1), end["at"]), F.array(end["right"]), F.slice(tokens, end["at"] + 2, F.size(tokens))), ""))


def repaired(reply: Column) -> Column:
    """The JSON of a reply: as it is, without a code fence, or with its one wrong closing
    bracket put right; null where that gives none."""
    bare = F.regexp_replace(F.trim(reply), "^```(json)?\\s*|\\s*```$", "")
    new = mended(bare)
    return F.when(F.length(bare) == 0, None).when(F.try_parse_json(bare).isNotNull(), bare).when(F.try_parse_json(new).isNotNull(), new)


def timeline(steps: Column, arms: list[str], number) -> Column:
    """Steps (t, p and arm as text) with their source rows, typed and in time order; a step
    without a time is left out, an arm that is none of ``arms`` is unclear."""
    typed = F.transform(
        steps,
        lambda s, i: F.struct(
            number(s["t"]).alias("t"), i.alias("source_row"), number(s["p"]).alias("p"),
            F.when(F.lower(s["arm"]).isin(arms), F.lower(s["arm"])).otherwise("unclear").alias("arm"),
        ),
    )
    return F.array_sort(F.filter(typed, lambda s: s["t"].isNotNull()))

"""Text expressions: normal forms, words, keys, clocks, tests and redaction."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Words that carry no content in short instructions.
STOP_WORDS = ["a", "an", "and", "at", "by", "for", "from", "in", "into", "is", "it", "of", "on", "or", "the", "then", "to", "with"]


def norm(s: Column) -> Column:
    """Lower case, trimmed, white space collapsed; null stays null."""
    return F.lower(F.trim(F.regexp_replace(s, "\\s+", " ")))


def plain(s: Column) -> Column:
    """Only a-z, 0-9 and single blanks."""
    return F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " "))


def word_list(s: Column) -> Column:
    return F.filter(F.split(plain(s), " "), lambda w: w != "")


def content_words(s: Column) -> Column:
    """The sorted set of words that are not stop words."""
    return F.array_sort(F.array_except(word_list(s), F.array(*map(F.lit, STOP_WORDS))))


def singular(w: Column) -> Column:
    """A rule-based singular of one lower-case word."""
    return (
        F.when(F.length(w) <= 3, w)
        .when(w.rlike("ies$"), F.regexp_replace(w, "ies$", "y"))
        .when(w.rlike("(ss|us|is)$"), w)
        .when(w.rlike("(ches|shes|xes|sses|zes)$"), F.regexp_replace(w, "es$", ""))
        .when(w.rlike("s$"), F.regexp_replace(w, "s$", ""))
        .otherwise(w)
    )


def word_bag(s: Column) -> Column:
    """Sorted singular words with their repeats: equal for reordered names."""
    return F.array_join(F.array_sort(F.transform(word_list(s), singular)), " ")


def trigrams(s: Column) -> Column:
    """The set of three-letter windows of the normal form, itself if shorter."""
    t = norm(s)
    return F.array_distinct(F.when(F.length(t) < 3, F.array(t)).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.length(t) - 2, F.lit(1))), lambda i: F.substring(t, i, F.lit(3)))))


def number(s: Column) -> Column:
    """Text such as 12.5 or 12.5s to a finite double, else null."""
    x = F.regexp_extract(F.trim(s), "^([+-]?[0-9]+(?:\\.[0-9]*)?(?:[eE][+-]?[0-9]+)?)s?$", 1)
    d = x.try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) < float("inf")), d)


def stored_number(x: Column) -> Column:
    """A finite double or null."""
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def clock(s: Column) -> Column:
    """Seconds as m:ss, rounded down."""
    return F.format_string("%d:%02d", F.floor(s / 60).cast("long"), F.floor(F.pmod(s, F.lit(60.0))).cast("long"))


def tenths(x: Column) -> Column:
    """One decimal, no negative zero."""
    r = F.round(x, 1)
    return F.when(r == 0, F.lit(0.0)).otherwise(r)


def and_list(items: Column) -> Column:
    """Items as an English list."""
    n = F.size(items)
    return F.when(n == 0, "").when(n == 1, F.element_at(items, 1)).otherwise(F.concat(F.array_join(F.slice(items, F.lit(1), n - 1), ", "), F.lit(" and "), F.element_at(items, -1)))


def first_text(*texts: Column) -> Column:
    """The first text that is not blank."""
    return F.coalesce(*(F.nullif(F.trim(t), F.lit("")) for t in texts))


def trailing_number(s: Column) -> Column:
    return F.nullif(F.regexp_extract(s, "([0-9]+)$", 1), F.lit("")).try_cast("long")


def one_of(x: Column, allowed: list[str], otherwise: str = "unclear") -> Column:
    """A value of an enumeration, else ``otherwise``; null stays null."""
    return F.when(x.isNull(), None).when(x.isin(*allowed), x).otherwise(otherwise)


def has_word(s: Column, words: list[str]) -> Column:
    """Whether a name, split at marks and at capitals, has one of the words."""
    split = F.regexp_replace(s, "([a-z0-9])([A-Z])", "$1 $2")
    return F.arrays_overlap(word_list(split), F.array(*map(F.lit, words)))


def fingerprint(*parts: Column) -> Column:
    """A content key: SHA-256 over parts, each with its length in front."""
    return F.sha2(F.concat(*(F.concat(F.coalesce(F.length(p), F.lit(-1)).cast("string"), F.lit(":"), F.coalesce(p, F.lit(""))) for p in parts)), 256)


def key_material(s: Column) -> Column:
    """A run of 20 letters or digits, or of 16 with a digit among them."""
    return s.rlike("[A-Za-z0-9]{20,}") | s.rlike("(?=[A-Za-z0-9]{16,})[A-Za-z]{0,15}[0-9]")


def mask_private(s: Column) -> Column:
    """E-mail addresses, bearer tokens and long key material masked.  Each pattern is
    tried only where its rare sign is."""
    out = F.when(F.contains(s, F.lit("@")), F.regexp_replace(s, "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}", "[email]")).otherwise(s)
    out = F.when(F.contains(F.lower(out), F.lit("bearer")), F.regexp_replace(out, "(?i)bearer\\s+[A-Za-z0-9._-]+", "[token]")).otherwise(out)
    return F.regexp_replace(out, "[A-Za-z0-9]{20,}+", "[key]")


def private_host(host: Column) -> Column:
    """Loopback, private ranges and internal names."""
    h = F.lower(host)
    return h.rlike("^(localhost|127\\.|10\\.|192\\.168\\.|169\\.254\\.|172\\.(1[6-9]|2[0-9]|3[01])\\.|\\[?::1\\]?$)") | h.rlike("\\.(internal|local|lan|corp)$")


def prompt_key(s: Column) -> Column:
    return F.sha2(norm(s), 256)


#: Words after which the rest of a clause is denied, supposed or doubted.
DENIALS = ["cannot", "if", "neither", "never", "no", "none", "nor", "not", "unless", "whether", "without"]
CLAUSE_ENDS = r"[.!?;:,\n]+| but | although | though | whereas "


def said(s: Column) -> Column:
    """The clauses of a text in plain form, a blank at both ends, each without what
    stands from its first word of denial on."""
    clause = lambda c: F.regexp_replace(F.concat(F.lit(" "), plain(c), F.lit(" ")), f" ({'|'.join(DENIALS)}) .*$", " ")
    return F.transform(F.split(F.lower(s), CLAUSE_ENDS), clause)


def asserted(s: Column, pattern: str) -> Column:
    """Whether a clause says ``pattern`` (of plain text) where it isn't denied."""
    return F.exists(said(s), lambda c: c.rlike(pattern))

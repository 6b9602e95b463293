"""Token counts by a two-tier lookup on the map side.

Frequent pre-tokens of a bounded sample go out as one compact broadcast table
(pre-token, number of tokens).  Everything else is encoded once per worker and
kept in a bounded cache.  No pre-token is ever shuffled; the result never
depends on what the table or a cache happens to hold.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F, types as T

from spanloom.llm.tokens import Chunks, groups
from spanloom.llm.words import quoted


@lru_cache(maxsize=4)
def pieces(path: str):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    joined = [p for p in map(model.id_to_piece, range(model.get_piece_size())) if "▁" in p.lstrip("▁") or "\n" in p]
    if joined or model.encode("", out_type=str) or model.encode("a  a", out_type=str) != model.encode("a", out_type=str) + model.encode(" a", out_type=str):
        raise ValueError(f"{path} has pieces across words, so texts can't be counted by pre-token")
    return model


def pre_tokens(text: str) -> list[str] | None:
    """A word after one blank, or a line end with what follows it; None where
    runs of blanks need the whole text."""
    if "  " in text or " \n" in text or "▁" in text or text[:1] in (" ", "\n") or text[-1:] == " ":
        return None
    return text.replace("\n", " \n").split(" ")


def lengths(path: str, new: list[str]) -> list[int]:
    """Numbers of tokens; a pre-token that begins with a line end has no blank before it."""
    return [len(ids) - (c[:1] == "\n") for c, ids in zip(new, pieces(path).encode(new, num_threads=1))]


@lru_cache(maxsize=4)
def known_lengths(path: str) -> Chunks:
    return Chunks(lambda new: lengths(path, new))


def frequent_table(docs: DataFrame, path: str, text: str, entries: int, sample_docs: int) -> tuple[bytes, bytes]:
    """The commonest pre-tokens of about ``sample_docs`` documents with their
    lengths: (texts parted by a blank, lengths as unsigned 16-bit integers).
    ``entries`` bounds its size; only speed depends on it."""
    total = docs.count()
    every = max(1, total // sample_docs)
    some = docs.where(F.pmod(F.xxhash64(quoted(text)), F.lit(every)) == 0).select(F.col(quoted(text)).alias("text"))

    def counted(batches):
        found: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                found.update(pre_tokens(t or "") or ())
            if len(found) > 8 * entries:
                found = Counter(dict(found.most_common(4 * entries)))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["w", "n"])

    top = some.mapInArrow(counted, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "w").limit(entries)
    words = [r.w for r in top.select("w").collect()]
    n = np.minimum(lengths(path, words), 65535).astype("<u2") if words else np.zeros(0, "<u2")
    keep = [k for k, (w, c) in enumerate(zip(words, n)) if len(w) < 256 and c < 65535]
    return " ".join(words[k] for k in keep).encode(), n[keep].tobytes()


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = 4096, entries: int = 65536, sample_docs: int = 2000) -> DataFrame:
    """``docs`` without its text, plus n_bytes (UTF-8), n_tokens and over_limit.

    ``path`` is a sentencepiece BPE model whose pieces never cross a word.  A
    null or empty text has 0 bytes and 0 tokens.  Columns of ``docs`` called
    n_bytes, n_tokens or over_limit are replaced.  Repeated rows stay.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent_table(docs, path, text, entries, sample_docs))
    out = ("n_bytes", "n_tokens", "over_limit")
    keep = [c for c in docs.columns if c != text and c not in out]

    def count(batches):
        cache = known_lengths(path)
        if not cache.first:
            words, n = table.value
            cache.first = dict(zip(words.decode().split(" "), np.frombuffer(n, "<u2").tolist())) if n else {"a": lengths(path, ["a"])[0]}
            cache.update(cache.first)
        get = cache.__getitem__
        for b in batches:
            n = []
            for some in groups(b.column(len(keep)).to_pylist()):
                parts = [pre_tokens(t) for t in some]
                cache.learn(set().union(*(p for p in parts if p)))
                n += [len(pieces(path).encode(t)) if p is None else sum(map(get, p)) for t, p in zip(some, parts)]
            n_bytes = pa.compute.fill_null(pa.compute.binary_length(b.column(len(keep)).cast(pa.binary())), 0).cast(pa.int64())
            tokens = pa.array(n, pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], n_bytes, tokens, pa.compute.greater(tokens, limit)], [*b.schema.names[: len(keep)], *out])

    # Any name is allowed in ``docs``, so its columns go by number.
    numbered = docs.select(*(F.col(quoted(c)).alias(f"c{k}") for k, c in enumerate(keep)), F.col(quoted(text)).alias("text"))
    added = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]
    return numbered.mapInArrow(count, T.StructType([*numbered.schema.fields[:-1], *added])).toDF(*keep, *out)

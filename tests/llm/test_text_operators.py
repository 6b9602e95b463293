"""Tokenisation, counting, packing and token files against plain versions."""

import binascii
from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from spanloom.llm import packing, queries, token_counts, token_files, tokens
from spanloom.session import new_folder

ODD = ["", "a", "  two  blanks ", "line\nend\n\n more", "\ttab", "É«ñ ünï 中文 字", "x" * 3000, "1234 5,6.7", "don't we'll", "<|endoftext|> <s>", "\u00a0nbsp\u2003em", "A\r\nB", "Ab, cd. Ef.", "▁under", "Straße ŉ İ", "\0nul", "end ", " start", "a \n b"]
WORD, BYTE, PIECE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))


def texts(spark, sf_dir):
    return [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]


def table(spark, rows):
    return spark.createDataFrame([(k, t, -1, "x") for k, t in rows], "doc_id long, text string, n_tokens int, score string").repartition(3)


@pytest.mark.parametrize("path, kind", [(WORD, "word"), (BYTE, "byte")])
def test_chunked_ids_are_the_library_s(spark, sf_dir, path, kind):
    some = ODD + texts(spark, sf_dir)
    whole = tokens.tokenizer(path).encode_batch(some, add_special_tokens=False)
    assert list(tokens.encode_texts(path, kind, some)) == [array("I", x.ids).tobytes() for x in whole]
    assert list(tokens.encode_texts(path, kind, [None])) == [b""]


def test_cache_is_emptied_at_its_limit():
    c = tokens.Chunks(lambda new: [x.upper() for x in new], 3, {"z": "Z"})
    for k in "abcdefg":
        c.learn({k, "z"})
        assert c[k] == k.upper() and c["z"] == "Z" and len(c) <= 4


def test_token_counts(spark, sf_dir):
    some = ODD + [None] + texts(spark, sf_dir)
    model = token_counts.pieces(PIECE)
    got = {r.doc_id: r for r in token_counts.count_tokens(table(spark, enumerate(some)), PIECE, entries=50, sample_docs=20).collect()}
    for k, t in enumerate(some):
        n = len(model.encode(t or ""))
        assert (got[k].n_tokens, got[k].n_bytes, got[k].over_limit, got[k].score) == (n, len((t or "").encode()), n > 4096, "x")
    assert token_counts.count_tokens(table(spark, []).limit(0), PIECE).count() == 0


def test_packing_holds_each_id_once_with_little_padding(spark, sf_dir):
    some = [(None, "null id"), (5, "same"), (5, "same"), (6, None), *enumerate(ODD + texts(spark, sf_dir)[:60], 10)]
    packed = packing.pack_documents(table(spark, some), WORD, length=256, windows=4, fan_in=2)
    sequences = packed.collect()
    ids = Counter()
    for r in sequences:
        assert 0 < r.n_tokens == len(r.ids) // 4 <= 256
        at = 0
        for p in r.pieces:
            assert p.offset == at
            at += p.length
            ids.update((p.doc_id, p.start + j, int(x)) for j, x in enumerate(np.frombuffer(r.ids, "<u4", p.length, 4 * p.offset)))
        assert at == r.n_tokens
    want = Counter()
    for k, t in some:
        own = [*np.frombuffer(next(tokens.encode_texts(WORD, "word", [t])), "<u4").tolist(), 2]
        want.update((k, j, x) for j, x in enumerate(own))
    assert ids == want
    assert len({r.sequence_id for r in sequences}) == len(sequences)
    padding = sum(256 - r.n_tokens for r in sequences if r.n_tokens & (r.n_tokens - 1))
    assert padding < 0.02 * sum(want.values())
    assert packing.pack_documents(table(spark, []).limit(0), WORD).count() == 0


def test_packing_digest(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.op2_packing(spark, sf_dir).collect():
        own = next(tokens.encode_texts(WORD, "word", [docs[r.doc_id]])) + array("I", [2]).tobytes()
        assert r.doc_tokens == len(own) // 4
        assert r.ids_crc32 == binascii.crc32(own[4 * r.start : 4 * (r.start + r.length)])


def test_token_files(spark, sf_dir):
    some = [(None, "null id"), (-3, "first"), (7, "twin"), (7, "twin"), *enumerate(ODD + texts(spark, sf_dir)[:50], 20)]
    path = new_folder(spark, "test-tokens")
    token_files.write_token_files(table(spark, some), path, BYTE, shard_bytes=20_000, dictionary_docs=20)
    got = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    want = sorted(some, key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for r, (k, t) in zip(got, want, strict=True):
        own = next(tokens.encode_texts(BYTE, "byte", [t])) + array("I", [2]).tobytes()
        assert (r.doc_id, r.start, r.n_tokens, bytes(r.ids)) == (k, start, len(own) // 4, own)
        start += r.n_tokens
    manifest = token_files.read_token_files(spark, path)
    assert manifest.count() == len(some)
    shard = sorted(spark.read.parquet(f"{path}/manifest").collect(), key=lambda r: r.start)[0]
    assert token_files.read_document(path, shard.file, 0) == np.frombuffer(got[0].ids, "<u4").tolist()
    with pytest.raises(IndexError):
        token_files.read_document(path, shard.file, shard.n_docs)
    with pytest.raises(ValueError):
        token_files.Shard(b"not a shard at all", b"")


def test_token_files_of_no_rows(spark):
    path = new_folder(spark, "test-tokens")
    assert token_files.write_token_files(table(spark, []).limit(0), path, BYTE).count() == 0
    assert token_files.read_token_files(spark, path).count() == 0

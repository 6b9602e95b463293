"""Token-id files: one zstandard dictionary for all, each document its own frame.

A data set is a folder of ``shard-PPPPPP-SSSS.tok`` files, ``dictionary`` and a
Parquet ``manifest`` (one row per shard with the number of ids before it).
A shard holds documents in ascending doc_id order:

    b"SLTOK1\\n" | width u8 (2 or 4 bytes an id) | sha256 of the dictionary
    frames, one per document, end to end
    index: has_id u8[n] | doc_id i64[n] | offset u64[n+1] | n_tokens u32[n]
    n u64 | position of the index u64 | b"SLTOKEND"

One document is read by two short reads: the index, then its frame.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from spanloom.llm.tokens import encode_texts, tokenizer
from spanloom.session import stored

MAGIC, END = b"SLTOK1\n", b"SLTOKEND"
MANIFEST = "part long, seq long, file string, n_docs long, n_tokens long, n_bytes long"


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system (local, HDFS, S3 and the like) and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def put(path: str, data: bytes) -> None:
    """Write a whole file under another name, then rename: a task that is run
    twice leaves the same file."""
    store, at = filesystem(path)
    store.create_dir(at.rpartition("/")[0], recursive=True)
    part = f"{at}.{TaskContext.get().taskAttemptId() if TaskContext.get() else 'd'}.tmp"
    with store.open_output_stream(part) as out:
        out.write(data)
    store.move(part, at)


def get(path: str) -> bytes:
    store, at = filesystem(path)
    with store.open_input_file(at) as f:
        return f.read()


def widths(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def greatest_id(path: str) -> int:
    """The greatest id that the tokenizer can give, added tokens included."""
    return max(tokenizer(path).get_vocab(with_added_tokens=True).values())


def train_dictionary(ids: DataFrame, size: int = 32768, sample_docs: int = 1000) -> bytes:
    """A shared dictionary from the one binary column of ``ids``, of which at most
    2 * ``sample_docs`` rows and the first 64 KB of each are taken; too few or too
    short ones give none (b"")."""
    rows = ids.limit(2 * sample_docs).select(F.substring(ids.columns[0], 1, 65536)).collect()
    try:
        return zstandard.train_dictionary(size, [bytes(r[0]) for r in rows]).as_bytes()
    except zstandard.ZstdError:
        return b""


def shard(rows: list[tuple], dictionary: bytes, width: str) -> bytes:
    """The bytes of a shard; rows: (doc_id or None, ids as bytes of ``width``)."""
    packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    frames = [packer.compress(ids) for _, ids in rows]
    head = MAGIC + bytes([int(width[2:])]) + hashlib.sha256(dictionary).digest()
    ends = np.cumsum([len(head), *map(len, frames)]).astype("<u8")
    index = [
        np.array([d is not None for d, _ in rows], "u1"),
        np.array([d or 0 for d, _ in rows], "<i8"),
        ends,
        np.array([len(ids) // int(width[2:]) for _, ids in rows], "<u4"),
        np.array([len(rows), ends[-1]], "<u8"),
    ]
    return b"".join([head, *frames, *(x.tobytes() for x in index), END])


class Shard:
    """Reads a shard; ``ids(k)`` needs only the k-th frame."""

    def __init__(self, data: bytes, dictionary: bytes):
        if data[: len(MAGIC)] != MAGIC or data[-len(END) :] != END:
            raise ValueError("not a token shard")
        self.data, self.width = data, f"<u{data[len(MAGIC)]}"
        if data[len(MAGIC) + 1 : len(MAGIC) + 33] != hashlib.sha256(dictionary).digest():
            raise ValueError("the shard was written with another dictionary")
        n, at = np.frombuffer(data, "<u8", 2, len(data) - len(END) - 16).tolist()
        has = np.frombuffer(data, "u1", n, at)
        self.doc_ids = [d if h else None for h, d in zip(has, np.frombuffer(data, "<i8", n, at + n).tolist())]
        self.ends = np.frombuffer(data, "<u8", n + 1, at + 9 * n).tolist()
        self.n_tokens = np.frombuffer(data, "<u4", n, at + 9 * n + 8 * (n + 1)).tolist()
        self.reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def ids(self, k: int) -> np.ndarray:
        return np.frombuffer(self.reader.decompress(self.data[self.ends[k] : self.ends[k + 1]]), self.width)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, kind: str = "byte", doc_id: str = "doc_id", text: str = "text", end_id: int = 2, shard_bytes: int = 32 << 20, dictionary_docs: int = 1000) -> DataFrame:
    """Write every whole text (null: empty) of ``docs`` with ``end_id`` after it
    to token files at ``path``; returns the manifest.

    An id takes two bytes where the tokenizer's greatest id fits, else four.
    Documents stand in ascending doc_id order, null ids first; equal ids in the
    order of a hash of their texts, so a hot id spreads over partitions.  Other
    columns are not stored.  An empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    width, end = widths(max(end_id + 1, greatest_id(tokenizer_path) + 1)), np.array([end_id], "<u4").tobytes()
    each = int(width[2:])
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.xxhash64(text).alias("tie"))

    def encoded(batches):
        for b in batches:
            ids = [np.frombuffer(x + end, "<u4").astype(width).tobytes() for x in encode_texts(tokenizer_path, kind, b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.binary())], ["doc_id", "tie", "ids"])

    # Texts are read and encoded once; what is sampled, sorted and shuffled are their ids.
    rows = stored(rows.select("doc_id", "tie", "text").mapInArrow(encoded, "doc_id long, tie long, ids binary"), "token-ids")
    every = max(1, rows.count() // dictionary_docs)
    dictionary = train_dictionary(rows.where(F.pmod(F.xxhash64("doc_id", "tie"), F.lit(every)) == 0).select("ids"), sample_docs=dictionary_docs)
    put(f"{path}/dictionary", dictionary)
    shared = spark.sparkContext.broadcast(dictionary)

    def write(batches):
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0
        done = []

        def flush():
            nonlocal seq, held, size
            name, data = f"shard-{part:06d}-{seq:04d}.tok", shard(held, shared.value, width)
            put(f"{path}/{name}", data)
            done.append((part, seq, name, len(held), size // each, len(data)))
            seq, held, size = seq + 1, [], 0

        for b in batches:
            for d, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.append((d, ids))
                size += len(ids)
                if size >= shard_bytes:
                    flush()
        if held:
            flush()
        yield pa.RecordBatch.from_pylist([dict(zip(("part", "seq", "file", "n_docs", "n_tokens", "n_bytes"), x)) for x in done], pa.schema([(c, pa.string() if c == "file" else pa.int64()) for c in ("part", "seq", "file", "n_docs", "n_tokens", "n_bytes")]))

    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "ids")
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{path}/shards")
    # One row a shard: small beside the ids, so one running sum over them is no bottleneck.
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    spark.read.schema(MANIFEST).parquet(f"{path}/shards").withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).write.parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


@lru_cache(maxsize=2)
def dictionary_of(path: str) -> bytes:
    return get(f"{path}/dictionary")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (binary,
    little-endian unsigned 32-bit integers) of every document in the files."""
    shards = spark.read.parquet(f"{path}/manifest").select("file", "start")
    shards = shards.repartition(max(1, min(shards.count(), 4096)))

    def read(batches):
        for b in batches:
            for name, start in zip(*(c.to_pylist() for c in b.columns)):
                s = Shard(get(f"{path}/{name}"), dictionary_of(path))
                n = np.array(s.n_tokens, np.int64)
                starts = start + np.cumsum(n) - n
                for k in range(0, len(n), 1024):
                    to = min(k + 1024, len(n))
                    yield pa.RecordBatch.from_arrays([pa.array(s.doc_ids[k:to], pa.int64()), pa.array(starts[k:to]), pa.array(n[k:to]), pa.array([s.ids(i).astype("<u4").tobytes() for i in range(k, to)], pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return shards.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def read_document(path: str, file: str, k: int) -> list[int]:
    """The ids of the k-th document of a shard by two short reads."""
    store, at = filesystem(f"{path}/{file}")
    with store.open_input_file(at) as f:
        size = f.size()
        n, index = np.frombuffer(f.read_at(16, size - len(END) - 16), "<u8").tolist()
        if not 0 <= k < n:
            raise IndexError(k)
        a, b = np.frombuffer(f.read_at(16, index + 9 * n + 8 * k), "<u8").tolist()
        width = f"<u{f.read_at(1, len(MAGIC))[0]}"
        held = dictionary_of(path)
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held) if held else None)
        return np.frombuffer(reader.decompress(f.read_at(b - a, a)), width).tolist()

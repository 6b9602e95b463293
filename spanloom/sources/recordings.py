"""Readers of recording formats on any file system that Spark reads, damaged parts as rows.

Spark lists the files and deals them to tasks; small parsers turn a file's bytes
into rows, which Spark then filters, joins and shuffles.  Each reader has a column
``problem``: null for a good row, else what was wrong, and reading goes on.  A file
must fit in a task (and under 2 GB), as its bytes come in one row.
"""

from __future__ import annotations

import io
import sqlite3
import struct
import zipfile
from contextlib import closing

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def rows_of(spark: SparkSession, path: str, pattern: str, parser, schema: str) -> DataFrame:
    """``parser(path, data)``'s rows of every file below ``path`` with a name like ``pattern``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    kinds = spark.createDataFrame([], schema).schema
    names = kinds.names
    arrow = pa.schema([(n, ARROW[kinds[n].dataType.simpleString()]) for n in names])

    def read(batches):
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1)):
                held = []
                for row in parser(name, data.as_py()):
                    held.append(dict(zip(names, row)))
                    if len(held) == 4096:
                        yield pa.RecordBatch.from_pylist(held, arrow)
                        held = []
                yield pa.RecordBatch.from_pylist(held, arrow)

    return files.select("path", "content").mapInArrow(read, schema)


ARROW = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}


def records(data: bytes):
    """(opcode, content) of MCAP records: a byte, a 64-bit length, the content."""
    at = 0
    while at + 9 <= len(data):
        op, n = struct.unpack_from("<BQ", data, at)
        if at + 9 + n > len(data):
            raise ValueError(f"record at {at} is cut off")
        yield op, data[at + 9 : at + 9 + n]
        at += 9 + n


def text(data: bytes, at: int) -> tuple[str, int]:
    (n,) = struct.unpack_from("<I", data, at)
    return data[at + 4 : at + 4 + n].decode(), at + 4 + n


MCAP_MAGIC = b"\x89MCAP0\r\n"
#: Fixed values of the format: channel, message and chunk records.
CHANNEL, MESSAGE, CHUNK = 4, 5, 6


def mcap_rows(path: str, data: bytes):
    channels: dict[int, tuple[str, str]] = {}

    def walk(data: bytes):
        for op, x in records(data):
            if op == CHANNEL:
                ident, _ = struct.unpack_from("<HH", x)
                topic, at = text(x, 4)
                channels[ident] = (topic, text(x, at)[0])
            elif op == MESSAGE:
                ident, sequence, log, published = struct.unpack_from("<HIQQ", x)
                topic, encoding = channels.get(ident, (None, None))
                yield (path, topic, encoding, sequence, log, published, x[22:], None if topic else f"no channel {ident}")
            elif op == CHUNK:
                packing, at = text(x, 28)
                (n,) = struct.unpack_from("<Q", x, at)
                body = x[at + 8 : at + 8 + n]
                if packing == "zstd":
                    import zstandard

                    body = zstandard.ZstdDecompressor().decompress(body, max_output_size=struct.unpack_from("<Q", x, 16)[0])
                elif packing:
                    yield (path, None, None, None, None, None, None, f"chunk packed as {packing}")
                    continue
                yield from walk(body)

    try:
        if not data.startswith(MCAP_MAGIC):
            raise ValueError("not an MCAP file")
        yield from walk(data[8:-8] if data.endswith(MCAP_MAGIC) else data[8:])
    except Exception as e:  # what was read before stays
        yield (path, None, None, None, None, None, None, f"{type(e).__name__}: {e}")


def mcap_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages of MCAP logs; chunks are plain or packed with zstandard."""
    return rows_of(spark, path, "*.mcap", mcap_rows, "file string, topic string, encoding string, sequence long, log_ns long, publish_ns long, data binary, problem string")


def bag_rows(path: str, data: bytes):
    try:
        with closing(sqlite3.connect(":memory:")) as db:
            db.deserialize(data)
            topics = {i: (n, t) for i, n, t in db.execute("SELECT id, name, type FROM topics")}
            for ident, topic, at, message in db.execute("SELECT id, topic_id, timestamp, data FROM messages ORDER BY id"):
                name, kind = topics.get(topic, (None, None))
                yield (path, ident, name, kind, at, message, None if name else f"no topic {topic}")
    except sqlite3.Error as e:
        yield (path, None, None, None, None, None, f"{type(e).__name__}: {e}")


def bag_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages of SQLite bags by id."""
    return rows_of(spark, path, "*.db3", bag_rows, "file string, id long, topic string, type string, t_ns long, data binary, problem string")


def array_rows(path: str, data: bytes):
    import numpy as np

    try:
        held = np.load(io.BytesIO(data), allow_pickle=False)
        for key in [None] if path.endswith(".npy") else held.files:
            try:
                a = held if key is None else held[key]
                flat = a.reshape(len(a), -1).astype(float) if a.ndim else a.reshape(1, 1).astype(float)
                for k, row in enumerate(flat):
                    yield (path, key, k, row.tolist(), None)
            except Exception as e:
                yield (path, key, None, None, f"{type(e).__name__}: {e}")
    except Exception as e:
        yield (path, None, None, None, f"{type(e).__name__}: {e}")


def array_values(spark: SparkSession, path: str) -> DataFrame:
    """Rows of NPY and NPZ arrays, other axes flattened."""
    return rows_of(spark, path, "*.np[yz]", array_rows, "file string, name string, row long, values array<double>, problem string")


LOCAL = b"PK\x03\x04"


def zip_rows(path: str, data: bytes):
    """Members by the central directory, checked against the local headers; with
    no readable directory, members found by their local headers alone."""
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            for m in z.infolist():
                bad = None
                if data[m.header_offset : m.header_offset + 4] != LOCAL:
                    bad = "no local header"
                else:
                    n = struct.unpack_from("<H", data, m.header_offset + 26)[0]
                    if data[m.header_offset + 30 : m.header_offset + 30 + n] != m.filename.encode("utf-8" if m.flag_bits & 0x800 else "cp437"):
                        bad = "another name in the local header"
                yield (path, m.filename, m.header_offset, m.compress_size, m.file_size, "directory", bad)
    except zipfile.BadZipFile as e:
        at = data.find(LOCAL)
        while at >= 0:
            size, full, n = struct.unpack_from("<IIH", data, at + 18)
            yield (path, data[at + 30 : at + 30 + n].decode("utf-8", "replace"), at, size, full, "local", str(e))
            at = data.find(LOCAL, at + 30)


def zip_members(spark: SparkSession, path: str) -> DataFrame:
    """Members of ZIP archives."""
    return rows_of(spark, path, "*.zip", zip_rows, "file string, member string, offset long, packed long, bytes long, found_by string, problem string")

"""WARC archives of pages with a two-level capture index.

A data set is a folder:

    archive-PPPPPP-SSSS-*.warc.gz   one gzip member per record
    index-PPPPPP-*.gz               captures in the order of their keys, in blocks of
                                    ``block_lines`` lines, one gzip member per block
    archives, blocks                Parquet: what the archives hold; the block directory

A capture's key is its URL with the host reversed ("org,example)/en/5").  The directory
has one row per block, its first key and where it lies: the upper level of the index.
``Captures`` finds a URL by a binary search of the directory, one range read of a block,
a binary search of its lines and one range read of a record.  ``read_archives`` goes
the same way for everything: blocks, then the records they name in runs of neighbours.

Files are written under names of their own by each attempt of a task, and only those
that a finished task reports are in the tables, so a lost executor leaves no half file.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spanloom.llm.token_files import filesystem
from spanloom.llm.url_filter import host_of
from spanloom.llm.words import free
from spanloom.session import stored

#: Fixed values of the WARC 1.1 format.
VERSION, CRLF = "WARC/1.1", b"\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Shorter payloads are never revisits.
LEAST_REVISIT = 100
#: A payload with this share of all rows or more is looked up by broadcast.
HOT_SHARE = 1e-4
BROADCAST_ROWS = 500_000
#: Bytes of neighbouring records that are read at once.
RUN_BYTES = 8 << 20
PAGE = re.compile(r"<urn:page:(-?\d+)>")
SAFE = "".join(map(chr, range(0x21, 0x7F))).replace("%", "")
CAPTURE = "key string, page_id long, kind string, file string, at long, size long"
CAPTURE_NAMES, CAPTURE_TYPES = [f.split(" ")[0] for f in CAPTURE.split(", ")], (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
BLOCKS = "first string, last string, part long, seq long, file string, at long, size long, lines long"


def url_key(url: Column) -> Column:
    """The host reversed, then all that follows it; A-Z of the host lower-cased, the scheme
    dropped.  Without a host: the URL after ``)``; null: empty."""
    after = F.regexp_extract(url, "^[\\s\\S]*?://[^/?#]*([\\s\\S]*)", 1)
    host = F.array_join(F.reverse(F.split(host_of(url), "\\.")), ",")
    return F.coalesce(F.when(F.contains(url, F.lit("://")), F.concat(host, F.lit(")"), after)).otherwise(F.concat(F.lit(")"), url)), F.lit(""))


def record(kind: str, page_id: int | None, url: str | None, date: str, payload: bytes, digest: str, refers_to: int | None = None) -> bytes:
    """One WARC record of an HTTP response with ``payload``; a revisit has its headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    heads = {
        "WARC-Type": kind, "WARC-Record-ID": page_urn(page_id), "WARC-Date": date,
        "WARC-Target-URI": None if url is None else quote(url, safe=SAFE), "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Profile": IDENTICAL if kind == "revisit" else None, "WARC-Refers-To": None if refers_to is None else page_urn(refers_to),
        "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block)),
    }
    head = "".join(f"{k}: {v}\r\n" for k, v in heads.items() if v is not None)
    return b"".join([f"{VERSION}\r\n{head}\r\n".encode(), block, CRLF, CRLF])


def page_urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(urn: str | None) -> int | None:
    m = PAGE.fullmatch(urn or "")
    return int(m[1]) if m else None


def fields(data: bytes) -> tuple[dict[str, str], int]:
    """Header fields (names lower-cased) after a first line, and where they end."""
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode().split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, end + 4


def parsed(data: bytes) -> dict:
    """What a record says: page_id, url, record_type, refers_to, payload_bytes,
    payload_digest and, for a response, payload, whose digest must be the one stated."""
    if not data.startswith(VERSION.encode()):
        raise ValueError("not a WARC record")
    head, at = fields(data)
    block = data[at : at + int(head["content-length"])]
    http, body = fields(block)
    out = {"page_id": page_of(head["warc-record-id"]), "url": unquote(head["warc-target-uri"]) if "warc-target-uri" in head else None, "record_type": head["warc-type"], "refers_to": page_of(head.get("warc-refers-to")), "payload_bytes": int(http["content-length"]), "payload_digest": head["warc-payload-digest"].partition(":")[2], "payload": None}
    if out["record_type"] == "response":
        out["payload"] = block[body:]
        if len(out["payload"]) != out["payload_bytes"] or hashlib.sha256(out["payload"]).hexdigest() != out["payload_digest"]:
            raise ValueError(f"payload of {head['warc-record-id']} does not have its digest")
    return out


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def unpacked(data: bytes) -> bytes:
    return zlib.decompress(data, 31)


class Writer:
    """Files of gzip members in a folder, a new one after ``most`` bytes.  A file has
    the attempt of its task in its name and appears whole, when it is closed."""

    def __init__(self, path: str, name: str, most: int):
        self.path, self.most, self.seq, self.out = path, most, 0, None
        self.name = f"{name}-{TaskContext.get().partitionId() if TaskContext.get() else 0:06d}"

    def add(self, data: bytes) -> tuple[str, int, int]:
        """file, position and size of what is added."""
        if self.out is not None and self.at >= self.most:
            self.close()
        if self.out is None:
            store, at = filesystem(self.path)
            store.create_dir(at, recursive=True)
            self.file, self.at = f"{self.name}-{self.seq:04d}-{uuid.uuid4().hex[:12]}{'.warc' if 'archive' in self.name else ''}.gz", 0
            self.out = store.open_output_stream(f"{at}/{self.file}", compression=None)
        packed, at = member(data), self.at
        self.out.write(packed)
        self.at += len(packed)
        return self.file, at, len(packed)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out, self.seq = None, self.seq + 1


def first_captures(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """digest, first (the smallest page_id), n of payloads that occur more than once
    and are long enough to be revisited; payloads are hashed where they lie."""
    long = pages.where(F.octet_length(html) >= LEAST_REVISIT)
    seen = long.groupBy(F.unhex(F.sha2(F.col(html).cast("binary"), 256)).alias("digest")).agg(F.min(F.col(page_id).cast("long")).alias("first"), F.count("*").alias("n"))
    return stored(seen.where("n > 1"), "repeated-payloads")


def with_first(pages: DataFrame, first: DataFrame, digest: str, out: str) -> DataFrame:
    """``pages`` with the page that first has its payload (column ``out``).  While they are
    few, repeated payloads are broadcast, and pages stay where they are; beyond that only
    hot ones (at most 1 / HOT_SHARE) are, and the others meet in a join."""
    names = first.select(F.col("digest").alias("_d_" + digest), F.col("first").alias("_f_" + digest), "n")
    d, f = F.col("_d_" + digest), F.col("_f_" + digest)
    if first.count() <= BROADCAST_ROWS:
        return pages.join(F.broadcast(names.drop("n")), F.col(digest) == d, "left").withColumn(out, f).drop(d, f)
    least = HOT_SHARE * first.agg(F.sum("n")).first()[0]
    hot = pages.join(F.broadcast(names.where(F.col("n") >= least).drop("n")), F.col(digest) == d, "left").withColumn(out, f).drop(d, f)
    # Rows that are done spread over keys that match nothing.
    alone = F.unhex(F.md5(F.monotonically_increasing_id().cast("string")))
    keyed = hot.withColumn("_k_" + digest, F.when(F.col(out).isNull(), F.col(digest)).otherwise(alone))
    met = keyed.join(names.where(F.col("n") < least).drop("n"), F.col("_k_" + digest) == d, "left")
    return met.withColumn(out, F.coalesce(F.col(out), f)).drop(d, f, F.col("_k_" + digest))


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = "1970-01-01T00:00:00Z", archive_bytes: int = 256 << 20, block_lines: int = 2000) -> DataFrame:
    """Write a record per row of ``pages`` and the index; returns the block directory.

    The payload is the html in UTF-8 (null: empty).  Of rows with equal payloads of at
    least 100 bytes that with the smallest page_id is a response, and so are rows that
    repeat its page_id; the others are revisits of it.  A null page_id comes after all
    others; where a payload has no other all its rows are responses.  A null url is
    left out of its record and has an empty key.  Other columns are not stored.  An
    empty table gives an empty index.
    """
    spark = pages.sparkSession
    first = first_captures(pages, page_id, html)
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    rows = with_first(rows, first, "digest", "first").select("page_id", "url", "payload", "digest", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"), url_key(F.col("url")).alias("key"))

    def write(batches):
        out = Writer(path, "archive", archive_bytes)
        for b in batches:
            for k in range(0, b.num_rows, 256):
                held = []
                for p, u, body, digest, refers, key in zip(*(c.to_pylist() for c in b.slice(k, 256).columns)):
                    kind = "response" if refers is None else "revisit"
                    held.append((key, p, kind, *out.add(record(kind, p, u, date, body, digest.hex(), refers))))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), CAPTURE_TYPES)], CAPTURE_NAMES)
        out.close()

    rows.mapInArrow(write, CAPTURE).write.parquet(f"{path}/archives")
    captures = spark.read.schema(CAPTURE).parquet(f"{path}/archives")
    return write_index(captures, path, block_lines)


def write_index(captures: DataFrame, path: str, block_lines: int = 2000) -> DataFrame:
    """The captures sorted by key into compressed blocks, and their directory."""

    def write(batches):
        out, held, done, part = Writer(path, "index", 1 << 30), [], [], TaskContext.get().partitionId()

        def flush():
            lines = [line(r) for r in held]
            done.append((held[0][0], held[-1][0], part, len(done), *out.add("".join(lines).encode()), len(lines)))
            held.clear()

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                held.append(r)
                if len(held) >= block_lines:
                    flush()
        if held:
            flush()
        out.close()
        names = [f.split(" ")[0] for f in BLOCKS.split(", ")]
        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in done], pa.schema([(n, pa.string() if n in ("first", "last", "file") else pa.int64()) for n in names]))

    # One URL may hold a third of the captures: the page, file and position part them.
    order = ["key", "page_id", "file", "at"]
    laid = captures.repartitionByRange(*order).sortWithinPartitions(*order)
    laid.select("key", "page_id", "kind", "file", "at", "size").mapInArrow(write, BLOCKS).write.parquet(f"{path}/blocks")
    return captures.sparkSession.read.schema(BLOCKS).parquet(f"{path}/blocks")


def line(capture: tuple) -> str:
    key, page_id, *rest = capture
    return " ".join([quote(key, safe=SAFE), "-" if page_id is None else str(page_id), *map(str, rest)]) + "\n"


def capture_of(text: str) -> tuple:
    key, page_id, kind, file, at, size = text.split(" ")
    return unquote(key), None if page_id == "-" else int(page_id), kind, file, int(at), int(size)


def range_read(path: str, file: str, at: int, size: int) -> bytes:
    store, folder = filesystem(path)
    with store.open_input_file(f"{folder}/{file}") as f:
        return f.read_at(size, at)


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """Every capture of the index, block by block."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").select("file", "at", "size")
    blocks = blocks.repartition("file", "at")

    def read(batches):
        for b in batches:
            for file, at, size in zip(*(c.to_pylist() for c in b.columns)):
                found = [capture_of(x) for x in unpacked(range_read(path, file, at, size)).decode().split("\n")[:-1]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), CAPTURE_TYPES)], CAPTURE_NAMES)

    return blocks.mapInArrow(read, CAPTURE)


RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to and payload
    (null: a revisit, or not asked for) of every record that the index names.

    Records that lie in the same stretch of a file are read together.  A payload that
    does not have its digest is an error.
    """
    stretch = F.floor(F.col("at") / RUN_BYTES)
    laid = read_captures(spark, path).select("file", "at", "size").repartition("file", stretch).sortWithinPartitions("file", "at")

    def read(batches):
        for b in batches:
            held, size = [], 0
            for data in runs(zip(*(c.to_pylist() for c in b.columns)), path):
                held.append(parsed(unpacked(data)) | ({} if payload else {"payload": None}))
                size += len(held[-1]["payload"] or b"")
                if len(held) >= 1024 or size > RUN_BYTES:
                    yield pa.RecordBatch.from_pylist(held, RECORD)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_pylist(held, RECORD)

    return laid.mapInArrow(read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def runs(places: Iterator[tuple], path: str) -> Iterator[bytes]:
    """The bytes of each place (file, at, size), in order; neighbours are read
    together, RUN_BYTES at a time or one greater record."""
    held: list[tuple] = []

    def read():
        start = held[0][1]
        data = range_read(path, held[0][0], start, held[-1][1] + held[-1][2] - start)
        for _, at, size in held:
            yield data[at - start : at - start + size]

    for p in places:
        if held and (p[0] != held[0][0] or p[1] != held[-1][1] + held[-1][2] or p[1] + p[2] - held[0][1] > RUN_BYTES):
            yield from read()
            held = []
        held.append(p)
    if held:
        yield from read()


class Captures:
    """Look-ups of URLs.  Holds of the block directory only what lies between the keys
    ``low`` and ``high``, and the last block that was read."""

    def __init__(self, path: str, low: str | None = None, high: str | None = None):
        store, at = filesystem(path)
        between = [("last", ">=", low), ("first", "<=", high)] if low is not None else None
        rows = pq.read_table(f"{at}/blocks", filesystem=store, filters=between).to_pylist()
        self.path, self.blocks = path, sorted(rows, key=lambda r: (r["part"], r["seq"]))
        self.firsts = [r["first"].encode() for r in self.blocks]
        self.read: tuple = (None, [], [])

    def lines(self, k: int) -> tuple[list[str], list[bytes]]:
        """The lines of the k-th block and their keys, by one range read."""
        if self.read[0] != k:
            b = self.blocks[k]
            lines = unpacked(range_read(self.path, b["file"], b["at"], b["size"])).decode().split("\n")[:-1]
            self.read = (k, lines, [unquote(x.partition(" ")[0]).encode() for x in lines])
        return self.read[1:]

    def find(self, key: str) -> list[tuple]:
        """All captures of a key: blocks by a binary search of the directory, lines by a
        binary search of each."""
        want, out = key.encode(), []
        k = max(0, bisect.bisect_left(self.firsts, want) - 1)
        while k < len(self.blocks) and self.firsts[k] <= want:
            if self.blocks[k]["last"].encode() >= want:
                lines, keys = self.lines(k)
                i = bisect.bisect_left(keys, want)
                while i < len(keys) and keys[i] == want:
                    out.append(capture_of(lines[i]))
                    i += 1
            k += 1
        return out

    def get(self, capture: tuple) -> dict:
        """The record of a capture by one range read; a revisit has no payload of its own."""
        return parsed(unpacked(range_read(self.path, *capture[3:])))


def lookup(urls: DataFrame, path: str, url: str = "url") -> DataFrame:
    """``urls`` (any number) with the captures of each: page_id, kind, file, at and size,
    null for a URL that was not captured.

    Distinct keys are sorted, so that a task asks neighbouring blocks and needs only
    their part of the directory.  Columns of ``urls`` with those names are replaced.
    """
    key = free(urls, "_key")
    urls = urls.drop("page_id", "kind", "file", "at", "size").withColumn(key, url_key(F.col(url)))
    asked = urls.select(F.col(key).alias("key")).distinct()

    def search(batches):
        for b in batches:
            keys = b.column(0).to_pylist()
            held = Captures(path, keys[0], keys[-1]) if keys else None
            found = [c for k in keys for c in held.find(k)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), CAPTURE_TYPES)], CAPTURE_NAMES)

    found = asked.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(search, CAPTURE)
    return urls.join(found.withColumnRenamed("key", key), key, "left").drop(key)

"""Bounded-space online packing of token ids into windows of a fixed length.

Each partition keeps a fixed number of open windows.  A piece goes into the
open window that it fills best.  When it fits none and no further window may be
opened, the fullest is topped up with the head of the piece and emitted.
Windows still open at the end are leftovers: they are dealt to fewer and fewer
tasks and packed again by the same rule until one task has the last of them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from spanloom.llm.tokens import encode_texts
from spanloom.session import stored

PIECE = pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("offset", pa.int64())])
SCHEMA = "sequence_id long, open boolean, n_tokens long, ids binary, pieces array<struct<doc_id:long,start:long,length:long,doc_tokens:long,offset:long>>"
ARROW = pa.schema([("sequence_id", pa.int64()), ("open", pa.bool_()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("pieces", pa.list_(PIECE))])


class Packer:
    """Packs pieces (doc_id, start, doc_tokens, ids as u32 bytes) into windows."""

    def __init__(self, length: int, windows: int, least_cut: int, first_id: int):
        self.length, self.windows, self.least_cut, self.next = length, windows, least_cut, first_id
        self.open: list[tuple[int, list]] = []  # (free tokens, pieces)
        self.out: list[tuple] = []

    def emit(self, pieces: list, leftover: bool = False) -> None:
        rows, at = [], 0
        for doc, start, total, ids in pieces:
            rows.append({"doc_id": doc, "start": start, "length": len(ids) // 4, "doc_tokens": total, "offset": at})
            at += len(ids) // 4
        self.out.append((self.next, leftover, at, b"".join(p[3] for p in pieces), rows))
        self.next += 1

    def add(self, doc, start: int, total: int, ids: bytes) -> None:
        whole = len(ids) // (4 * self.length)
        for k in range(whole):
            self.emit([(doc, start + k * self.length, total, ids[4 * self.length * k : 4 * self.length * (k + 1)])])
        start, ids = start + whole * self.length, ids[4 * self.length * whole :]
        while ids:
            n = len(ids) // 4
            best = min((w for w in self.open if w[0] >= n), key=lambda w: w[0], default=None)
            if best:
                self.open.remove(best)
                best[1].append((doc, start, total, ids))
                if best[0] == n:
                    self.emit(best[1])
                else:
                    self.open.append((best[0] - n, best[1]))
                return
            if len(self.open) < self.windows:
                self.open.append((self.length - n, [(doc, start, total, ids)]))
                return
            fullest = min(self.open, key=lambda w: w[0])
            self.open.remove(fullest)
            free = fullest[0]
            if free >= self.least_cut:
                fullest[1].append((doc, start, total, ids[: 4 * free]))
                start, ids = start + free, ids[4 * free :]
            self.emit(fullest[1])

    def close(self, last: bool) -> None:
        """The open windows as leftovers; if ``last``, joined end to end, and what
        fills no whole window cut at powers of two, which need no padding."""
        if not last:
            for _, pieces in self.open:
                self.emit(pieces, leftover=True)
        else:
            rest, size = [p for _, pieces in self.open for p in pieces], self.length
            left = sum(len(p[3]) // 4 for p in rest)
            while left:
                while size > left:
                    size = 1 << (left.bit_length() - 1)
                take, room = [], size
                while room:
                    doc, start, total, ids = rest.pop(0)
                    n = min(room, len(ids) // 4)
                    take.append((doc, start, total, ids[: 4 * n]))
                    if 4 * n < len(ids):
                        rest.insert(0, (doc, start + n, total, ids[4 * n :]))
                    room -= n
                self.emit(take)
                left -= size
        self.open = []

    def batch(self) -> pa.RecordBatch:
        out, self.out = self.out, []
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(ARROW)], schema=ARROW)


def pack_documents(docs: DataFrame, tokenizer: str, kind: str = "word", doc_id: str = "doc_id", text: str = "text", end_id: int = 2, length: int = 4096, windows: int = 16, least_cut: int = 16, fan_in: int = 64) -> DataFrame:
    """Sequences of at most ``length`` ids: sequence_id, n_tokens, ids (binary,
    little-endian u32, no padding) and pieces (doc_id, start in the document's
    ids, length, doc_tokens, offset in the sequence).

    Every text (null: empty) gives its ids and then ``end_id``; each id lies in
    exactly one piece.  A document is cut where it is longer than a window, and
    where at least ``least_cut`` free places of a full window would else be
    padding.  Repeated rows and equal ids are packed each for itself; a null
    doc_id is kept.  Other columns are not carried.
    """
    end = np.array([end_id], "<u4").tobytes()

    def pack(level: int, last: bool):
        def run(batches):
            p = Packer(length, windows, least_cut, level << 58 | TaskContext.get().partitionId() << 32)
            for b in batches:
                if level:
                    for ids, pieces in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                        for x in pieces:
                            p.add(x["doc_id"], x["start"], x["doc_tokens"], ids[4 * x["offset"] : 4 * (x["offset"] + x["length"])])
                else:
                    for doc, ids in zip(b.column(0).to_pylist(), encode_texts(tokenizer, kind, b.column(1).to_pylist())):
                        p.add(doc, 0, len(ids) // 4 + 1, ids + end)
                        if len(p.out) >= 256:
                            yield p.batch()
                yield p.batch()
            p.close(last)
            yield p.batch()

        return run

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    tasks, level = max(1, rows.rdd.getNumPartitions()), 0
    out = stored(rows.mapInArrow(pack(0, False), SCHEMA), "packed")
    done, left = out.where("not open"), out.where("open")
    while True:
        level, tasks = level + 1, math.ceil(tasks / fan_in)
        again = stored(left.select("ids", "pieces").repartition(tasks).mapInArrow(pack(level, tasks == 1), SCHEMA), "packed")
        done, left = done.unionByName(again.where("not open")), again.where("open")
        if tasks == 1:
            return done.drop("open")


def digest(packed: DataFrame) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32 (of its ids as
    little-endian unsigned 32-bit integers), doc_tokens, sequence_id, offset."""
    pieces = packed.select("sequence_id", "ids", F.explode("pieces").alias("p"))
    own = F.substring("ids", (F.col("p.offset") * 4 + 1).cast("int"), (F.col("p.length") * 4).cast("int"))
    return pieces.select("p.doc_id", "p.start", "p.length", F.crc32(own).alias("ids_crc32"), "p.doc_tokens", "sequence_id", "p.offset")

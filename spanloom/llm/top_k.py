"""Exact top-k inner products over vectors sorted by descending length.

Vectors are packed into blocks in order of length.  A rotation by the singular
vectors of a bounded sample puts most of the mass into the first coordinates.
For each query, a block (or part of one) is skipped where length times length
is under the k-th best score so far; of the rest, a pair is skipped where the
partial sum over the first coordinates plus the product of the residual lengths
(Cauchy-Schwarz) is under it.  What is left is scored exactly in integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from spanloom.session import stored

BLOCK, QUERY_BLOCK, SAMPLE, PART = 4096, 2048, 4096, 512
FIRST = 16
#: At most as many blocks of queries are broadcast by their numbers (20 bytes each).
NUMBERS = 1_000_000
EXACT = 2.0**53
PACKED = "block long, dim int, most double, n int, ids binary, rows binary, asks binary"


def integers(vector: Column) -> Column:
    """floor(1024 * x) of every component; null for a vector that is null or
    holds null, NaN or infinite components."""
    x = F.transform(vector, lambda v: v.cast("double"))
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(good, F.transform(x, lambda v: F.floor(v * 1024)))


def rotation(rows: np.ndarray) -> np.ndarray:
    """Right singular vectors, strongest first; any orthonormal basis keeps the bounds true."""
    return np.linalg.svd(rows, full_matrices=True)[2].T if len(rows) else np.eye(rows.shape[1])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of a with all of b (both int64), held at
    the ends of a long."""
    longest = lambda m: float(np.abs(m.astype(float)).max(initial=0)) * m.shape[1] ** 0.5
    if longest(a) * longest(b) < EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, -(1 << 63), (1 << 63) - 1).astype(np.int64)


class Best:
    """The k best (score, vec_id) of each query, ties to the smaller vec_id."""

    def __init__(self, n: int, k: int, least: np.ndarray):
        self.k, self.rows, self.least = k, [[] for _ in range(n)], least.copy()

    def add(self, q: int, scores, ids) -> None:
        some = sorted([*self.rows[q], *((-s, i) for s, i in zip(scores, ids))])[: self.k]
        self.rows[q] = some
        if len(some) == self.k:
            self.least[q] = max(self.least[q], float(-some[-1][0]))


def search(q: np.ndarray, q_at: np.ndarray, least: np.ndarray, c: np.ndarray, c_ids: np.ndarray, c_at: np.ndarray, turn: np.ndarray, k: int) -> Best:
    """Best k of the candidates c (longest first) for each query; *_at tell rows apart."""
    best = Best(len(q), k, least)
    qr, cr = q @ turn, c @ turn
    q_len, c_len = np.linalg.norm(qr, axis=1), np.linalg.norm(cr, axis=1)
    q_res, c_res = np.linalg.norm(qr[:, FIRST:], axis=1), np.linalg.norm(cr[:, FIRST:], axis=1)
    for at in range(0, len(c), PART):
        part = slice(at, at + PART)
        slack = 1e-9 * q_len * c_len[part].max(initial=0) + 1e-6
        live = np.flatnonzero(q_len * c_len[part].max(initial=0) + slack >= best.least)
        if not len(live):
            break  # later ones are no longer
        bound = qr[live, :FIRST] @ cr[part, :FIRST].T + np.outer(q_res[live], c_res[part])
        keep = (bound + slack[live, None] >= best.least[live, None]) & (q_at[live, None] != c_at[None, part])
        rows, cols = np.flatnonzero(keep.any(1)), np.flatnonzero(keep.any(0))
        if not len(rows):
            continue
        scores = products(q[live[rows]], c[part][cols])
        for j, row in enumerate(rows):
            own = keep[row, cols]
            s, ids = scores[j][own], c_ids[part][cols][own]
            if len(s) > k:
                cut = np.partition(s, len(s) - k)[len(s) - k]
                s, ids = s[s >= cut], ids[s >= cut]
            best.add(int(live[row]), s.tolist(), ids.tolist())
    return best


def unpack(dim: int, ids: bytes, rows: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(rows, np.int64).reshape(-1, dim)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for every row that ``is_query``
    (a condition on the long column vec_id) the k rows with the highest integer
    inner products, all if fewer, ties to the smaller vec_id.

    Candidates are all rows but the query's own; a repeated row is another row.
    Vectors that are null or hold null or non-finite components, and rows with a
    null id, take no part; vectors of other dimension than the query's neither.
    An empty vector's products are 0.  Integers and scores beyond a long are held
    at its end.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), integers(F.col(embedding)).alias("v")).where("vec_id is not null and v is not null")
    rows = rows.withColumns({"asks": F.coalesce(is_query, F.lit(False)), "dim": F.size("v"), "norm": F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))})

    def pack(batches):
        part, count, held = TaskContext.get().partitionId(), 0, []

        def block():
            nonlocal count, held
            dim = held[0][2]
            out = {"block": part << 32 | count, "dim": dim, "most": held[0][3], "n": len(held), "ids": np.array([h[0] for h in held], np.int64).tobytes(), "rows": np.array([h[1] for h in held], np.int64).reshape(-1, dim).tobytes(), "asks": np.array([h[4] for h in held]).tobytes()}
            count, held = count + 1, []
            return pa.RecordBatch.from_pylist([out], pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("most", pa.float64()), ("n", pa.int32()), ("ids", pa.binary()), ("rows", pa.binary()), ("asks", pa.binary())]))

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if held and (held[0][2] != row[2] or len(held) == BLOCK):
                    yield block()
                held.append(row)
        if held:
            yield block()

    # Equal lengths are dealt by id, so a vector that fills a third of the rows spreads.
    ordered = rows.repartitionByRange("dim", F.desc("norm"), "vec_id").sortWithinPartitions("dim", F.desc("norm"), "vec_id")
    blocks = stored(ordered.select("vec_id", "v", "dim", "norm", "asks").mapInArrow(pack, PACKED), "vectors")
    sizes = blocks.groupBy("dim").agg(F.sum("n").alias("n"), F.count("*").alias("b")).collect()
    turns, heads = {}, {}
    for dim, in {(s["dim"],) for s in sizes}:
        # The rotation comes from one block's worth of vectors and the first bounds from the longest.
        some = blocks.where(F.col("dim") == dim).orderBy(F.xxhash64("block")).limit(1).collect()[0]
        turns[dim] = rotation(unpack(dim, some["ids"], some["rows"])[1][:SAMPLE].astype(float)) if dim else np.eye(0)
        head = blocks.where(F.col("dim") == dim).orderBy(F.desc("most"), "block").limit(1).collect()[0]
        heads[dim] = (head["block"], head["ids"], head["rows"])
    turns, heads = spark.sparkContext.broadcast(turns), spark.sparkContext.broadcast(heads)

    def queries(batches):
        """The rows of blocks that ask; ``at``, the block's number and the place in it, tells rows apart."""
        for b in batches:
            for block, dim, ids, data, asks in zip(*(c.to_pylist() for c in b.columns)):
                own, m = unpack(dim, ids, data)
                k = np.flatnonzero(np.frombuffer(asks, bool))
                if len(k):
                    yield pa.RecordBatch.from_arrays([pa.array(own[k]), pa.array([dim] * len(k), pa.int32()), pa.array(block * BLOCK + k), pa.array([r.tobytes() for r in m[k]], pa.binary())], ["vec_id", "dim", "at", "row"])

    # A first pass finds each query's bound among the longest vectors; queries of like
    # reach (the length that a vector must have to matter) then share a block.
    asked = blocks.select("block", "dim", "ids", "rows", "asks").mapInArrow(queries, "vec_id long, dim int, at long, row binary")

    def bounded(batches):
        for b in batches:
            dims = b.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                some = b.filter(pa.array(dims == dim))
                for at in range(0, some.num_rows, QUERY_BLOCK):
                    part = some.slice(at, QUERY_BLOCK)
                    q = np.frombuffer(b"".join(part.column(3).to_pylist()), np.int64).reshape(-1, dim)
                    block, ids, data = heads.value[dim]
                    h_ids, h = unpack(dim, ids, data)
                    best = search(q, part.column(2).to_numpy(), np.full(len(q), -np.inf), h, h_ids, block * BLOCK + np.arange(len(h)), turns.value[dim], k)
                    lengths = np.linalg.norm(q.astype(float), axis=1)
                    with np.errstate(divide="ignore", invalid="ignore"):
                        reach = np.where(lengths > 0, best.least / lengths, -np.inf)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(best.least), pa.array(reach)], ["vec_id", "dim", "at", "row", "least", "reach"])

    bounds = stored(asked.mapInArrow(bounded, "vec_id long, dim int, at long, row binary, least double, reach double"), "bounds")

    def gather(batches):
        """Rows that follow each other in order of reach, as blocks of queries."""
        part, count = TaskContext.get().partitionId(), 0
        for b in batches:
            dims = b.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                some = b.filter(pa.array(dims == dim))
                for at in range(0, some.num_rows, QUERY_BLOCK):
                    own = some.slice(at, QUERY_BLOCK)
                    data = [own.column(0).to_numpy().tobytes(), own.column(2).to_numpy().tobytes(), b"".join(own.column(3).to_pylist()), own.column(4).to_numpy().tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array([part << 32 | count]), pa.array([dim], pa.int32()), pa.array([float(own.column(5).to_numpy().min())]), *(pa.array([x], pa.binary()) for x in data)], ["qb", "dim", "reach", "q_ids", "q_at", "q_rows", "least"])
                    count += 1

    asking = bounds.count()
    ordered = bounds.repartitionByRange(max(1, min(8192, -(-asking // QUERY_BLOCK))), "dim", "reach", "at").sortWithinPartitions("dim", "reach", "at")
    q_blocks = stored(ordered.mapInArrow(gather, "qb long, dim int, reach double, q_ids binary, q_at binary, q_rows binary, least binary"), "queries")
    # Which blocks meet is told by their numbers alone; vectors go only to pairs that can still better a query.
    lengths = blocks.select("block", "dim", "most").withColumnRenamed("dim", "d")
    numbers = q_blocks.select("qb", "dim", "reach")
    numbers = F.broadcast(numbers) if asking <= NUMBERS * QUERY_BLOCK else numbers
    pairs = lengths.join(numbers, (F.col("dim") == F.col("d")) & (F.col("most") * (1 + 1e-9) + 1e-6 >= F.col("reach"))).select("qb", "block")
    pairs = stored(pairs, "pairs")
    met = pairs.join(blocks.select("block", "dim", "ids", "rows"), "block").join(q_blocks.select("qb", "q_ids", "q_at", "q_rows", "least"), "qb")
    pairs = met.repartition(max(1, min(pairs.count(), 4096)))

    def score(batches):
        for b in batches:
            for r in b.to_pylist():
                ids, c = unpack(r["dim"], r["ids"], r["rows"])
                q_ids, q = unpack(r["dim"], r["q_ids"], r["q_rows"])
                q_at = np.frombuffer(r["q_at"], np.int64)
                best = search(q, q_at, np.frombuffer(r["least"], float), c, ids, r["block"] * BLOCK + np.arange(len(ids)), turns.value[r["dim"]], k)
                flat = [(int(q_ids[i]), int(q_at[i]), v, -s) for i, own in enumerate(best.rows) for s, v in own]
                yield pa.RecordBatch.from_arrays([pa.array([f[j] for f in flat], pa.int64()) for j in range(4)], ["query_id", "q_at", "vec_id", "score"])

    found = pairs.select("block", "dim", "ids", "rows", "q_ids", "q_at", "q_rows", "least").mapInArrow(score, "query_id long, q_at long, vec_id long, score long")
    order = Window.partitionBy("q_at").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Order-dependent work on recordings: rows of a key stream through a task in order.

A key may be as long as it likes: what a kernel holds is stated with it (a part, a lag,
a state), never the key.  ``streamed`` deals keys to tasks and hands each kernel its
rows as NumPy columns, a batch at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema


class Kernel:
    """Takes a key's rows in order, ``add`` a batch of columns, ``end`` after the last;
    both return columns of rows that are done, or None."""

    def add(self, *columns: np.ndarray) -> tuple | None:
        raise NotImplementedError

    def end(self) -> tuple | None:
        return None


def streamed(df: DataFrame, keys: list[str], order: list[str], columns: dict[str, Column], make: Callable[[], Kernel], out: str, descending: bool = False) -> DataFrame:
    """keys and the columns ``out`` ("name type, ..." of bigint, int, double, boolean or arrays of
    them) that a kernel makes of each key's ``columns`` (numbers: null is NaN; arrays of
    numbers, none null and all of one length: a matrix, null elements NaN) in ``order``."""
    fields = T.StructType.fromDDL(out).fields
    schema = T.StructType([*(T.StructField(k, df.schema[k].dataType) for k in keys), *fields])
    rows = df.select(F.xxhash64(*(F.col(k) for k in keys)).alias("_h"), *keys, *(F.col(o).alias(f"_o{j}") for j, o in enumerate(order)), *(c.alias("_c_" + n) for n, c in columns.items()))
    laid = rows.repartition(*keys).sortWithinPartitions(*keys, *(F.col(f"_o{j}").desc() if descending else f"_o{j}" for j in range(len(order)))).select("_h", *keys, *("_c_" + n for n in columns))
    kinds = [f.type for f in to_arrow_schema(T.StructType(fields))]
    n_keys, n_columns, names = len(keys), len(columns), [*keys, *(f.name for f in fields)]

    def made(key: list, got: tuple | None) -> Iterator[pa.RecordBatch]:
        if got is not None and len(got[0]):
            arrays = [pa.array([k] * len(got[0]), t) for k, t in zip(*key)]
            yield pa.RecordBatch.from_arrays([*arrays, *(as_arrow(c, t) for c, t in zip(got, kinds))], names)

    def run(batches):
        held, kernel, key = None, None, None
        for b in batches:
            h = b.column(0).to_numpy()
            starts = [0, *(np.flatnonzero(h[1:] != h[:-1]) + 1).tolist(), len(h)] if len(h) else []
            for s, e in zip(starts[:-1], starts[1:]):
                if kernel is None or h[s] != held:
                    if kernel is not None:
                        yield from made(key, kernel.end())
                    held, kernel = h[s], make()
                    key = [b.column(1 + j)[s].as_py() for j in range(n_keys)], [b.schema.field(1 + j).type for j in range(n_keys)]
                yield from made(key, kernel.add(*(as_numpy(b.column(1 + n_keys + j).slice(s, e - s)) for j in range(n_columns))))
        if kernel is not None:
            yield from made(key, kernel.end())

    return laid.mapInArrow(run, schema)


def as_numpy(a: pa.Array) -> np.ndarray:
    if pa.types.is_list(a.type):
        flat = a.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
        return flat.reshape(len(a), -1) if len(a) else flat.reshape(0, 0)
    if pa.types.is_integer(a.type) and not a.null_count or pa.types.is_boolean(a.type):
        return a.to_numpy(zero_copy_only=False)
    return a.cast(pa.float64()).to_numpy(zero_copy_only=False)


def as_arrow(c, kind: pa.DataType) -> pa.Array:
    """Plain numbers and lists of Python values stay as they are, NaN of a float is null; a
    matrix becomes lists."""
    if isinstance(c, list):
        return pa.array(c, kind)
    if c.ndim == 2:
        return pa.ListArray.from_arrays(pa.array(np.arange(0, c.size + 1, c.shape[1], dtype=np.int32)), pa.array(c.reshape(-1), from_pandas=True))
    return pa.array(c, kind, from_pandas=c.dtype.kind == "f")

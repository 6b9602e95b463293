"""Readers and writers over Spark's own formats, with errors kept as rows."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON Lines (plain or gzip), one row a line; a line that does not parse keeps
    its text in _corrupt and its file in _file."""
    held = StructType(schema.fields).add("_corrupt", "string")
    rows = spark.read.schema(held).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return rows.withColumn("_file", F.input_file_name())


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_tables(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Parquet files of like tables by column name; a column that one lacks is null."""
    out = None
    for p in paths:
        one = spark.read.parquet(p)
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Every file below a folder with its size and time; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return found.select("path", F.col("length").alias("bytes"), "modificationTime")


def authoritative(df: DataFrame, keys: list[str], precedence: list[Column]) -> DataFrame:
    """The row of each key that ranks first, for replies in several files."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*precedence))).where("_k = 1").drop("_k")


def remaining(todo: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What a resumed run has still to do."""
    return todo.join(done.select(*keys).distinct(), keys, "left_anti")


def write_grouped(df: DataFrame, path: str, key: str, order: list[str]) -> DataFrame:
    """Parquet files with one row group for each key, keys in ascending order;
    returns file, key, n_rows for every row group.  A key's rows must fit in a
    task, as a row group does in any reader."""
    schema = df.schema
    names = df.columns
    fields = pa.schema([("file", pa.string()), ("key", pa.string()), ("n_rows", pa.int64())])

    def write(batches):
        store, at = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
        store.create_dir(at, recursive=True)
        name, writer, held, made, now = f"part-{TaskContext.get().partitionId():06d}.parquet", None, [], [], None
        part = f"{at}/.{name}.{TaskContext.get().taskAttemptId()}"

        def flush():
            nonlocal held, writer
            if held:
                whole = pa.Table.from_batches(held)
                writer = writer or pq.ParquetWriter(part, whole.schema, filesystem=store, compression="zstd")
                writer.write_table(whole, row_group_size=max(1, whole.num_rows))
                made.append({"file": name, "key": str(now), "n_rows": whole.num_rows})
                held = []

        for b in batches:
            keys = b.column(names.index(key)).to_pylist()
            start = 0
            for k in range(len(keys) + 1):
                if k == len(keys) or (keys[k] != now and (k or held)):
                    if k > start:
                        held.append(b.slice(start, k - start))
                    start = k
                    if k < len(keys):
                        flush()
                if k < len(keys):
                    now = keys[k]
        flush()
        if writer:
            writer.close()
            store.move(part, f"{at}/{name}")
        yield pa.RecordBatch.from_pylist(made, fields)

    ordered = df.repartitionByRange(key).sortWithinPartitions(key, *order)
    assert schema == ordered.schema
    return ordered.mapInArrow(write, "file string, key string, n_rows long")


def generation(path: str) -> tuple[int, dict[str, str]] | None:
    """The number of a published table's newest generation and its folders: one under "" or one
    for each bucket of keys."""
    store, at = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
    found = store.get_file_info(fs.FileSelector(at, allow_not_found=True))
    names = sorted(f.base_name for f in found if f.base_name.startswith("pointer-"))
    if not names:
        return None
    with store.open_input_file(f"{at}/{names[-1]}") as f:
        folders = dict(line.split("\t") for line in f.read().decode().split("\n"))
    return int(names[-1].split("-")[1]), {k: f"{path}/{v}" for k, v in folders.items()}


def point(path: str, number: int, own: str, folders: dict[str, str]) -> None:
    """Write the pointer of a generation, or raise where another writer's is there already."""
    store, at = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
    with store.open_output_stream(f"{at}/.{own}") as f:
        f.write("\n".join(f"{k}\t{v}" for k, v in folders.items()).encode())
    store.move(f"{at}/.{own}", f"{at}/pointer-{number:08d}-{own}")
    found = store.get_file_info(fs.FileSelector(at))
    if any(f.base_name.startswith(f"pointer-{number:08d}-") and not f.base_name.endswith(own) for f in found):
        store.delete_file(f"{at}/pointer-{number:08d}-{own}")
        raise RuntimeError(f"another writer has published generation {number} of {path}")


def publish(df: DataFrame, path: str) -> None:
    """Write ``df`` as a new generation of the table at ``path`` and then one small file that
    points to it.  Readers (``published``) see one generation whole, never none.  Of two
    writers that start from one generation at most one succeeds: who finds another's
    pointer of the same number beside its own takes its own back and raises."""
    now = generation(path)
    number, own = (now[0] + 1 if now else 0), uuid.uuid4().hex
    name = f"generation-{number:08d}-{own}"
    df.write.parquet(f"{path}/{name}")
    point(path, number, own, {"": name})


def merge(df: DataFrame, path: str, key: str, version: str, buckets: int = 64) -> None:
    """Fold rows into the table at ``path``, the highest ``version`` of a key winning, as a new
    generation: only the buckets (by a hash of ``key``) that have new rows are read and written
    again, the others are pointed to where they lie.  Of two writers at most one succeeds."""
    spark, now = df.sparkSession, generation(path)
    number, own = (now[0] + 1 if now else 0), uuid.uuid4().hex
    name = f"generation-{number:08d}-{own}"
    held = now[1] if now else {}
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets))
    touched = {str(r[0]) for r in df.select(bucket).distinct().collect()}
    if not touched:
        return None if held else publish(df.limit(0), path)
    if "" in held:  # a table that was published whole: all of it is dealt into buckets
        old = [held[""]]
    else:
        old = [v for k, v in held.items() if k in touched]
    both = spark.read.schema(df.schema).parquet(*old).unionByName(df) if old else df
    last = both.groupBy(key).agg(F.max_by(F.struct(*df.columns), version).alias("r")).select("r.*")
    last.withColumn("_b", bucket.cast("string")).repartition("_b").write.partitionBy("_b").parquet(f"{path}/{name}")
    written = touched if "" not in held else {str(k) for k in range(buckets)}
    store, at = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
    there = {f.base_name[3:] for f in store.get_file_info(fs.FileSelector(f"{at}/{name}")) if f.base_name.startswith("_b=")}
    kept = {k: v[len(path) + 1 :] for k, v in held.items() if k and k not in written}
    point(path, number, own, kept | {k: f"{name}/_b={k}" for k in sorted(there)})


def published(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path`` as last published, None where nothing is."""
    now = generation(path)
    return spark.read.parquet(*now[1].values()) if now else None

"""An index of recordings over Parquet files, and reads that touch only the files asked for.

Files hold many recordings and a recording may lie in several.  The index says which
file has which of its rows; a read takes the files from it, so that Spark opens no
other, and leaves columns and keys to the scan.  Rows without an owner are in no
recording and are never attached to one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A read that needs more files than this opens the folder and lets the keys decide.
MOST_FILES = 5_000


def recording_index(rows: DataFrame, key: str, frame: str) -> DataFrame:
    """key, file, first and last (places of its rows in the file), n, of the file's rows of each
    key, and frames_first and frames_last of its frames.  ``rows`` is read from Parquet files;
    only two columns of them and the places are read.  Rows with a null key are left out."""
    d = rows.select(F.col(key), F.col(frame).alias("_f"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("_row")).where(F.col(key).isNotNull())
    return d.groupBy(key, "file").agg(F.min("_row").alias("first"), F.max("_row").alias("last"), F.count("*").alias("n"), F.countDistinct("_f").alias("frames"), F.min("_f").alias("frames_first"), F.max("_f").alias("frames_last"))


def recordings(index: DataFrame, key: str) -> DataFrame:
    """key, n, files, together (its rows stand side by side in one file) and problem: "frames" where
    a recording's frames are not 0 to n - 1, each once, else null."""
    whole = index.groupBy(key).agg(F.sum("n").alias("n"), F.count("*").alias("files"), F.sum("frames").alias("_f"), F.min("frames_first").alias("_a"), F.max("frames_last").alias("_z"), F.max(F.col("last") - F.col("first") + 1 - F.col("n")).alias("_gap"))
    sound = (F.col("_a") == 0) & (F.col("_z") == F.col("n") - 1) & (F.col("_f") == F.col("n"))
    return whole.select(key, "n", "files", ((F.col("files") == 1) & (F.col("_gap") == 0)).alias("together"), F.when(~F.coalesce(sound, F.lit(False)), "frames").alias("problem"))


def read_recordings(spark: SparkSession, path: str, index: DataFrame, key: str, asked: DataFrame | list, columns: list[str], most_files: int = MOST_FILES) -> DataFrame:
    """``columns`` of the rows of the asked recordings (values, or a table with ``key``).

    Files that hold none of them are not opened, columns that are not asked for not read,
    and values go down to the scan as a filter.  Where they lie in more than
    ``most_files`` files, all are opened and the keys decide.
    """
    few = not isinstance(asked, DataFrame)
    wanted = index.where(F.col(key).isin(asked)) if few else index.join(asked.select(key).distinct(), key, "left_semi")
    files = [r.file for r in wanted.select("file").distinct().limit(most_files + 1).collect()]
    if not files:
        return spark.read.parquet(path).select(*columns).limit(0)
    # Files of one folder by their own names: what the folder's name says of a column is kept by basePath.
    reader = spark.read.option("basePath", path)
    rows = reader.parquet(*files) if len(files) <= most_files else reader.parquet(path)
    own = rows.where(F.col(key).isin(asked)) if few else rows.join(asked.select(key).distinct(), key, "left_semi")
    return own.select(*columns)


def table_labels(claims: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, label, why and rows: what a table of recorded codes says of each value of ``key``.

    label is the one text among ``fields`` that isn't blank, if all rows of the value say the
    same; else it is null, with why: "conflicting rows" or "no unique text".  Rows are
    owned by the recorded value alone, never by their place; null keys own none.
    """
    texts = F.filter(F.array(*(F.trim(F.col(f)) for f in fields)), lambda t: t.isNotNull() & (t != ""))
    said = F.struct(*(F.col(f).alias(f"f{k}") for k, f in enumerate(fields)))
    d = claims.where(F.col(key).isNotNull()).select(key, said.alias("said"), texts.alias("texts"))
    g = d.groupBy(key).agg(F.count("*").alias("rows"), F.min("said").alias("_a"), F.max("said").alias("_z"), F.min("texts").alias("_t"))
    why = F.when(~F.col("_a").eqNullSafe(F.col("_z")), "conflicting rows").when(F.size("_t") != 1, "no unique text")
    return g.select(key, F.when(why.isNull(), F.get("_t", F.lit(0))).alias("label"), why.alias("why"), "rows")


def same_length_swaps(vocabulary: DataFrame, word: str) -> DataFrame:
    """wrong, place and right: every spelling of a vocabulary word with two neighbouring letters
    swapped; one that is itself a word is none, of several words' the one swapped first."""
    words = vocabulary.select(F.lower(word).alias("right")).where(F.length("right") >= 2).distinct()
    k, n = F.col("place"), F.length("right")
    swapped = F.concat(F.substring("right", F.lit(1), k - 1), F.substring("right", k + 1, F.lit(1)), F.substring("right", k, F.lit(1)), F.substring("right", k + 2, n))
    every = words.withColumn("place", F.explode(F.sequence(F.lit(1), n - 1))).withColumn("wrong", swapped).where("wrong <> right")
    known = every.join(words.select(F.col("right").alias("wrong")), "wrong", "left_anti")
    return known.groupBy("wrong").agg(F.min(F.struct("place", "right")).alias("b")).select("wrong", "b.place", "b.right")


def spelled(texts: DataFrame, key: str, text: str, vocabulary: DataFrame, word: str, shortest: int = 4) -> DataFrame:
    """``texts`` with fixed: the text with every word that one swap keeps from being a word of the
    vocabulary put right (its length and all offsets stay), and swaps, how many words that were.

    Distinct words of a text meet the vocabulary's swaps by equality, so work grows with
    the texts and not with their words' lengths or the vocabulary.  Words in capitals or with a
    capital first are put right in that form, but for letters whose capital is longer than they
    are (ß), which stay.  ``key`` is unique; a null text stays null.
    """
    pieces = F.regexp_extract_all(F.col(text), F.lit("\\p{L}+|[^\\p{L}]+"), F.lit(0))
    long = F.array_distinct(F.filter(pieces, lambda p: (F.length(p) >= shortest) & p.rlike("^\\p{L}")))
    swaps = same_length_swaps(vocabulary, word)
    said = texts.select(key, F.explode(long).alias("_w")).withColumn("wrong", F.lower("_w"))
    hit = said.join(swaps, "wrong")
    capital = lambda x: F.when(F.length(F.upper(x)) == F.length(x), F.upper(x)).otherwise(x)
    letters = F.array_join(F.transform(F.split("right", ""), capital), "")
    form = F.when(F.col("_w") == F.upper("_w"), letters).when(F.substring("_w", 1, 1) != F.lower(F.substring("_w", 1, 1)), F.concat(capital(F.substring("right", 1, 1)), F.substring("right", F.lit(2), F.length("right")))).otherwise(F.col("right"))
    found = hit.where(F.length(form) == F.length("_w")).groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(F.col("_w"), form.alias("r")))).alias("_m"))
    d = texts.join(found, key, "left")
    new = F.array_join(F.transform(pieces, lambda p: F.coalesce(F.try_element_at("_m", p), p)), "")
    count = F.size(F.filter(pieces, lambda p: F.map_contains_key("_m", p)))
    return d.withColumns({"fixed": F.when(F.col("_m").isNull(), F.col(text)).otherwise(new), "swaps": F.when(F.col("_m").isNull(), 0).otherwise(count).cast("long")}).drop("_m")


def union_all(tables: list[DataFrame]) -> DataFrame:
    """Like tables one under the other, a column that one lacks null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def file_name(path: Column) -> Column:
    """The last part of a path."""
    return F.element_at(F.split(path, "/"), -1)

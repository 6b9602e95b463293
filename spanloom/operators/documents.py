"""Documents of unknown depth: their fields, what a schema leaves out, rewritten copies.

JSON is parsed once to VARIANT.  ``leaves`` opens LEVELS levels of all documents in one pass
and goes on with what is deeper still; no document meets another.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from spanloom.session import stored

WITHHELD = "[withheld]"
#: Levels that one pass opens; deeper documents take more passes.
LEVELS = 4


def kind_of(v: Column) -> Column:
    """object, array, integer, number, string, boolean, null or what else a VARIANT holds."""
    s = F.regexp_extract(F.schema_of_variant(v), "^[A-Z_]+", 0)
    names = {"OBJECT": "object", "ARRAY": "array", "BIGINT": "integer", "DOUBLE": "number", "DECIMAL": "number", "STRING": "string", "BOOLEAN": "boolean", "VOID": "null"}
    whole = F.schema_of_variant(v).rlike("^DECIMAL\\(\\d+,0\\)")
    return F.when(whole, "integer").otherwise(F.coalesce(*(F.when(s == k, n) for k, n in names.items()), F.lower(s)))


def full(v: str) -> Column:
    """Whether a VARIANT is an object or array with parts."""
    size = lambda kind: F.coalesce(F.size(F.try_variant_get(v, "$", kind)), F.lit(0))
    return (size("map<string,variant>") > 0) | (size("array<variant>") > 0)


def opened(level: DataFrame, keys: list[str]) -> DataFrame:
    """keys, path, pointer, depth, v and open (whether v holds others) with the parts of every
    open value in its place."""
    # Only what stays goes on beside the parts, not the whole beside each of them.
    d = level.withColumns({"_own": F.when(~F.col("open"), F.col("v")), "v": F.when(F.col("open"), F.col("v"))})
    inner = d.lateralJoin(d.sparkSession.tvf.variant_explode_outer(F.col("v").outer()))
    part = F.col("pos").isNotNull()
    step = F.when(F.col("key").isNull(), F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]"))).otherwise(F.concat(F.when(F.col("path") == "", "").otherwise("."), "key"))
    token = F.coalesce(F.replace(F.replace("key", F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1")), F.col("pos").cast("string"))
    path, pointer = F.when(part, F.concat("path", step)).otherwise(F.col("path")), F.when(part, F.concat("pointer", F.lit("/"), token)).otherwise(F.col("pointer"))
    return inner.select(*keys, path.alias("path"), pointer.alias("pointer"), (F.col("depth") + part.cast("int")).alias("depth"), F.when(part, F.col("value")).otherwise(F.col("_own")).alias("v"), F.when(part, full("value")).otherwise(False).alias("open"))


def leaves(df: DataFrame, keys: list[str], document: Column) -> DataFrame:
    """keys, path ("a.b[0]"), pointer ("/a/b/0"), depth, kind and value (text, null for null
    and for what is empty) of every leaf of each document.

    A leaf is a value that holds no other: a number, a text, a null, an empty object or
    array.  The document itself is one if it is a plain value.  A text that is no JSON
    has no leaves, and neither has a null.  Repeated rows give repeated leaves.
    """
    level = df.select(*keys, F.lit("").alias("path"), F.lit("").alias("pointer"), F.lit(0).alias("depth"), F.try_parse_json(document).alias("v")).withColumn("open", full("v"))
    found = []
    while True:
        for _ in range(LEVELS):
            level = opened(level, keys)
        level = level.where("v is not null").withColumn("kind", kind_of(F.col("v")))
        text = F.when(~F.col("kind").isin("object", "array", "null"), F.try_variant_get("v", "$", "string"))
        level = stored(level.withColumns({"value": text, "v": F.when(F.col("open"), F.col("v"))}), "nested")
        found.append(level.where("not open").select(*keys, "path", "pointer", "depth", "kind", "value"))
        level = level.where("open").select(*keys, "path", "pointer", "depth", "v", "open")
        if level.isEmpty():
            break
    return reduce(DataFrame.unionByName, found)


def field_types(found: DataFrame) -> DataFrame:
    """Of ``leaves`` of many documents: field (its path with every place as []), kinds (sorted), n,
    nulls, documents' deepest place and greatest place in an array."""
    # Paths repeat from document to document, so each is read once.
    d = found.groupBy("path", "kind").agg(F.count("*").alias("n"), F.max("depth").alias("depth"))
    place = F.array_max(F.transform(F.regexp_extract_all("path", F.lit("\\[(\\d+)\\]"), F.lit(1)), lambda x: x.cast("long")))
    d = d.withColumns({"field": F.regexp_replace("path", "\\[\\d+\\]", "[]"), "place": place})
    nulls = F.sum(F.when(F.col("kind") == "null", F.col("n")).otherwise(0))
    return d.groupBy("field").agg(F.array_sort(F.collect_set(F.when(F.col("kind") != "null", F.col("kind")))).alias("kinds"), F.sum("n").alias("n"), nulls.alias("nulls"), F.max("depth").alias("depth"), F.max("place").alias("place"))


def uncovered(found: DataFrame, covered: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows of ``leaves`` that no row of ``covered`` (pointer, and ``keys`` if given) is or stands
    above.  Every leaf asks for itself and all above it, so the paths are met by equality."""
    keys = keys or []
    # Pointers repeat from document to document, so each (of each key) is met once.
    own = found.select(*keys, "pointer").distinct()
    parts = F.split(F.col("pointer"), "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    known = covered.select(*keys, F.col("pointer").alias("_above")).distinct()
    hit = own.select(*keys, "pointer", F.explode(above).alias("_above")).join(known, [*keys, "_above"], "left_semi").select(*keys, "pointer").distinct()
    return found.join(hit, [*keys, "pointer"], "left_anti").select(found.columns)


Rule = Callable[[str, Column], Column]


def rewritten(column: Column, kind: T.DataType, dropped: Callable[[str, str], bool], text: Rule, path: str = "") -> Column | None:
    """A nested column without the fields that ``dropped`` (path, name) names, every text
    passed through ``text`` (path, value); null where the column itself is dropped.

    Fields keep their order, arrays their places and their nulls, maps their keys but those
    whose entry ``dropped`` names with the key's path only.  The expression follows the type, so
    Spark sees one projection and reads only what is kept.
    """
    if isinstance(kind, T.StructType):
        fields = []
        for f in kind.fields:
            at = f"{path}.{f.name}" if path else f.name
            if not dropped(at, f.name):
                new = rewritten(column.getField(f.name), f.dataType, dropped, text, at)
                if new is not None:
                    fields.append(new.alias(f.name))
        return F.when(column.isNotNull(), F.struct(*fields)) if fields else None
    if isinstance(kind, T.ArrayType):
        probe = rewritten(F.lit(None).cast(kind.elementType), kind.elementType, dropped, text, path + "[]")
        return None if probe is None else F.transform(column, lambda x: rewritten(x, kind.elementType, dropped, text, path + "[]"))
    if isinstance(kind, T.MapType):
        probe = rewritten(F.lit(None).cast(kind.valueType), kind.valueType, dropped, text, path + "{}")
        return None if probe is None else F.transform_values(column, lambda _, v: rewritten(v, kind.valueType, dropped, text, path + "{}"))
    return text(path, column) if isinstance(kind, T.StringType) else column


def rewritten_rows(df: DataFrame, dropped: Callable[[str, str], bool], text: Rule) -> DataFrame:
    """``df`` with every column rewritten; columns that are dropped, or of which nothing is left, are gone."""
    out = []
    for f in df.schema.fields:
        if not dropped(f.name, f.name):
            new = rewritten(F.col(f"`{f.name.replace('`', '``')}`"), f.dataType, dropped, text, f.name)
            if new is not None:
                out.append(new.alias(f.name))
    return df.select(*out)


def rewritten_value(value, dropped: Callable[[str, str], bool], text: Callable[[str, str], str | None], path: str = ""):
    """The same for a parsed JSON value: fields in their order, list places kept."""
    if isinstance(value, dict):
        out = {}
        for k, v in value.items():
            at = f"{path}.{k}" if path else k
            if not dropped(at, k):
                out[k] = rewritten_value(v, dropped, text, at)
        return out
    if isinstance(value, list):
        return [rewritten_value(v, dropped, text, path + "[]") for v in value]
    return text(path, value) if type(value) is str else value


class Digits(str):
    """A number as it is written."""


def rewritten_json(df: DataFrame, column: str, dropped: Callable[[str, str], bool], text: Callable[[str, str], str | None], out: str) -> DataFrame:
    """``df`` with ``out``: the JSON of ``column`` rewritten value by value, null where it is no
    JSON.  Numbers keep every digit.  For documents whose types are not known; typed columns
    are better served by ``rewritten``."""
    plain = df.toDF(*(f"c{k}" for k in range(len(df.columns))))
    at = df.columns.index(column)
    schema = T.StructType([*plain.schema.fields, T.StructField(out, T.StringType())])

    # Numbers with a point travel as marked texts, so that no digit is lost.
    mark = uuid.uuid4().hex

    def again(t: str | None) -> str | None:
        try:
            value = None if t is None else json.loads(t, parse_float=lambda digits: Digits(mark + digits))
            again = None if t is None else json.dumps(rewritten_value(value, dropped, text), ensure_ascii=False, separators=(",", ":"))
        except (ValueError, RecursionError):
            return None
        return None if again is None else re.sub(f'"{mark}([^"]*)"', "\\1", again)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(map(again, b.column(at).to_pylist()), pa.string())], [*b.schema.names, out])

    return plain.mapInArrow(run, schema).toDF(*df.columns, out)

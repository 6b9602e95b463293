"""Nested documents against recursive walks in Python."""

import json
import random

from pyspark.sql import functions as F, types as T

from spanloom.operators import documents


def kind(v):
    if v is None:
        return "null"
    return {bool: "boolean", int: "integer", float: "number", str: "string", dict: "object", list: "array"}[type(v)]


def walk(v, path="", pointer="", depth=0):
    if isinstance(v, dict) and v:
        for k, x in v.items():
            yield from walk(x, f"{path}.{k}" if path else k, f"{pointer}/{k.replace('~', '~0').replace('/', '~1')}", depth + 1)
    elif isinstance(v, list) and v:
        for k, x in enumerate(v):
            yield from walk(x, f"{path}[{k}]", f"{pointer}/{k}", depth + 1)
    else:
        yield path, pointer, depth, kind(v)


def made(draw, depth=0):
    r = draw.random()
    if depth < 5 and r < 0.35:
        return {draw.choice(["a", "b", "c/d", "e~f", "é"]): made(draw, depth + 1) for _ in range(draw.randint(0, 3))}
    if depth < 5 and r < 0.6:
        return [made(draw, depth + 1) for _ in range(draw.randint(0, 3))]
    return draw.choice([None, True, False, 0, -7, 12345678901234567, 1.5, 1e300, "", "text", "key-1234"])


def documents_of(n=60):
    draw = random.Random(7)
    return [(k, json.dumps(made(draw))) for k in range(n)] + [(100, None), (101, "{broken"), (102, ""), (103, "{}"), (104, '"plain"'), (105, json.dumps({"x": {"y": [{"z": k} for k in range(300)]}}))]


def test_leaves_are_those_of_a_walk(spark):
    docs = documents_of()
    df = spark.createDataFrame(docs, "id long, doc string")
    got = sorted((r.id, r.path, r.pointer, r.depth, r.kind) for r in documents.leaves(df, ["id"], F.col("doc")).collect())
    want = []
    for k, t in docs:
        try:
            want += [(k, *x) for x in walk(json.loads(t or "{broken"))]
        except ValueError:
            pass
    assert got == sorted(want)
    assert {r.value for r in documents.leaves(df.where("id = 105"), ["id"], F.col("doc")).collect()} == {str(k) for k in range(300)}
    assert documents.leaves(df.limit(0), ["id"], F.col("doc")).count() == 0


def test_field_types(spark):
    df = spark.createDataFrame([(1, '{"a": [{"b": 1}, {"b": "x"}, {"b": null}], "c": 2.5}'), (2, '{"a": [], "c": 3}')], "id long, doc string")
    got = {r.field: (r.kinds, r.n, r.nulls, r.depth, r.place) for r in documents.field_types(documents.leaves(df, ["id"], F.col("doc"))).collect()}
    assert got == {"a[].b": (["integer", "string"], 3, 1, 3, 2), "c": (["integer", "number"], 2, 0, 1, None), "a": (["array"], 1, 0, 1, None)}


def test_uncovered_by_prefix(spark):
    df = spark.createDataFrame(documents_of(), "id long, doc string")
    found = documents.leaves(df, ["id"], F.col("doc")).cache()
    known = ["/a", "/b/0", "/c~1d/e~0f", "/x/y"]
    got = sorted((r.id, r.pointer) for r in documents.uncovered(found, spark.createDataFrame([(p,) for p in known + known], "pointer string")).collect())
    assert got == sorted((r.id, r.pointer) for r in found.collect() if not any(r.pointer == p or r.pointer.startswith(p + "/") for p in known))
    own = spark.createDataFrame([(105, "/x"), (3, "")], "id long, pointer string")
    got = {r.id for r in documents.uncovered(found, own, ["id"]).collect()}
    assert 105 not in got and 3 not in got and 104 in got


SECRET = {"token", "password"}


def gone(path, name):
    return name in SECRET or path == "a.b.hidden"


def masked(path, value):
    return documents.WITHHELD if value.startswith("key-") else value


def plain(v, path=""):
    if isinstance(v, dict):
        return {k: plain(x, f"{path}.{k}" if path else k) for k, x in v.items() if not gone(f"{path}.{k}" if path else k, k)}
    if isinstance(v, list):
        return [plain(x, path + "[]") for x in v]
    return masked(path, v) if isinstance(v, str) else v


def test_rewritten_json_keeps_order_places_and_digits(spark):
    docs = documents_of() + [(200, '{"z": 1, "token": {"q": 1}, "a": {"b": {"hidden": 1, "shown": [1.10, 12345678901234567890, "key-9", null]}}, "hidden": "key"}')]
    df = spark.createDataFrame(docs, "id long, doc string").withColumnRenamed("id", "i.d")
    drop = lambda path, name: name in ("token", "password") or path == "a.b.hidden"
    mask = lambda path, value: "[withheld]" if value.startswith("key-") else value
    got = {r[0]: r.out for r in documents.rewritten_json(df, "doc", drop, mask, "out").collect()}
    for k, t in docs:
        try:
            want = plain(json.loads(t or "{broken"))
        except ValueError:
            assert got[k] is None
            continue
        assert json.loads(got[k]) == want and list(json.loads(got[k])) == list(want) if isinstance(want, dict) else json.loads(got[k]) == want
    assert got[200] == '{"z":1,"a":{"b":{"shown":[1.10,12345678901234567890,"[withheld]",null]}},"hidden":"key"}'


def test_rewritten_columns_follow_the_type(spark):
    inner = T.StructType([T.StructField("hidden", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("token", T.StringType())])
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("a", T.StructType([T.StructField("b", inner), T.StructField("list", T.ArrayType(inner))])),
        T.StructField("m", T.MapType(T.StringType(), inner)), T.StructField("only", T.ArrayType(T.StructType([T.StructField("token", T.StringType())]))), T.StructField("t.x", T.StringType()), T.StructField("password", T.StringType()),
    ])
    one = (4, "key-1", "s")
    rows = [(1, (one, [one, None, (5, "n", None)]), {"k": one, "n": None}, [("t",)], "key-2", "p"), (2, None, None, None, None, None), (3, (None, []), {}, [], "x", "")]
    df = spark.createDataFrame(rows, schema)
    text = lambda _, c: F.when(c.startswith("key-"), documents.WITHHELD).otherwise(c)
    out = documents.rewritten_rows(df, gone, text)
    assert out.columns == ["id", "a", "m", "t.x"]
    assert out.schema["a"].dataType["b"].dataType.names == ["name"] and out.schema["a"].dataType["list"].dataType.elementType.names == ["hidden", "name"]
    got = {r.id: r.asDict(True) for r in out.collect()}
    assert got[1] == {"id": 1, "a": {"b": {"name": "[withheld]"}, "list": [{"hidden": 4, "name": "[withheld]"}, None, {"hidden": 5, "name": "n"}]}, "m": {"k": {"hidden": 4, "name": "[withheld]"}, "n": None}, "t.x": "[withheld]"}
    assert got[2] == {"id": 2, "a": None, "m": None, "t.x": None} and got[3] == {"id": 3, "a": {"b": None, "list": []}, "m": {}, "t.x": "x"}


def test_documents_are_opened_in_few_passes(spark, monkeypatch):
    def deep(v, n):
        for k in range(n):
            v = [v] if k % 2 else {"a": v, "b": k}
        return v

    docs = [(10 * n + k, json.dumps(deep(v, n))) for n in range(16) for k, v in enumerate([None, {}, [], [None], {"x": None}, 5])]
    passes, kept = [], documents.stored
    monkeypatch.setattr(documents, "stored", lambda d, name: (passes.append(name), kept(d, name))[1])
    df = spark.createDataFrame(docs, "id long, doc string")
    got = sorted((r.id, r.path, r.pointer, r.depth, r.kind) for r in documents.leaves(df, ["id"], F.col("doc")).collect())
    assert got == sorted((k, *x) for k, t in docs for x in walk(json.loads(t)))
    assert len(passes) == 4  # 16 levels, 4 a pass
    passes.clear()
    documents.uncovered(documents.leaves(df.where("id < 30"), ["id"], F.col("doc")), spark.createDataFrame([("/a",)], "pointer string")).count()
    assert len(passes) == 1

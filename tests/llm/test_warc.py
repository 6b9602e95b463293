"""WARC archives: round trips, the index against a plain search, revisits."""

import gzip
import hashlib
import random
import re
from urllib.parse import urlsplit

import pytest
from pyspark.sql import functions as F

from spanloom.llm import warc
from spanloom.llm.token_files import filesystem
from spanloom.session import new_folder

SCHEMA = "page_id long, url string, html string"


def plain_key(url):
    if url is None:
        return ""
    if "://" not in url:
        return ")" + url
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return ",".join(reversed(low.split("."))) + ")" + rest[len(host) :]


def test_edge_rows_come_back(spark):
    long, copy = "<p>" + "x" * 3_000_000, "é" * 60
    rows = [(3, "http://A.b.C/x?y#z", copy), (1, "http://c/", copy), (1, "http://d/", copy), (None, None, copy), (5, "", None), (6, "no scheme\r\nX: y %41 ü", "short"), (7, "https://h/7", "short"), (8, "http://long/", long), (9, "http://n1/", "z" * 100), (10, "http://n2/", "z" * 99), (11, "http://n3/", "z" * 99)]
    rows += [(None, "http://null/1", "n" * 200), (None, "http://null/2", "n" * 200)]
    pages = spark.createDataFrame(rows, SCHEMA).withColumns({"first": F.lit(1), "digest": F.lit("d"), "a.b": F.lit(2)})
    path = new_folder(spark, "warc-test")
    warc.write_archives(pages, path, block_lines=2)
    got = warc.read_archives(spark, path).collect()
    revisits = {(3, "http://A.b.C/x?y#z"): 1, (None, None): 1}
    want = [(p, u, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest(), "revisit" if (p, u) in revisits else "response", revisits.get((p, u)), None if (p, u) in revisits else (h or "").encode()) for p, u, h in rows]
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((*r[:6], None if r.payload is None else bytes(r.payload)) for r in got), key=key) == sorted(want, key=key)
    # Any gzip reader sees plain WARC records, one after the other.
    store, at = filesystem(path)
    archives = [r.file for r in spark.read.parquet(f"{path}/archives").select("file").distinct().collect()]
    text = b"".join(gzip.decompress(store.open_input_file(f"{at}/{f}").read()) for f in archives)
    assert text.count(b"WARC/1.1\r\n") == len(rows) and text.count(warc.IDENTICAL.encode()) == 2


def test_index_finds_every_url(spark):
    draw = random.Random(4)
    urls = [f"http://{draw.choice(['a', 'b', 'www.b', 'é'])}.{draw.choice(['com', 'org'])}/{draw.randint(0, 40)}" for _ in range(400)] + ["http://hot.com/"] * 200
    pages = spark.createDataFrame([(k, u, f"page {k}") for k, u in enumerate(urls)], SCHEMA)
    path = new_folder(spark, "warc-test")
    blocks = warc.write_archives(pages, path, archive_bytes=4096, block_lines=16)
    assert blocks.agg(F.sum("lines")).first()[0] == len(urls) and blocks.count() >= len(urls) // 16
    held = warc.Captures(path)
    for u in [*sorted(set(urls)), "http://none.com/", "http://a.com/999", ""]:
        found = held.find(plain_key(u))
        assert sorted(c[1] for c in found) == [k for k, v in enumerate(urls) if v == u]
        for c in found[:2]:
            record = held.get(c)
            assert (record["page_id"], record["url"], record["payload"]) == (c[1], u, f"page {c[1]}".encode())
    asked = spark.createDataFrame([(u, 1) for u in set(urls)] + [("http://none.com/", 2), (None, 3)], "url string, size int")
    got = warc.lookup(asked, path)
    assert sorted((r.url, r.page_id) for r in got.where("page_id is not null").collect()) == sorted((u, k) for k, u in enumerate(urls))
    assert got.where("page_id is null").count() == 2


def test_keys(spark):
    urls = [None, "", "x", "http://", "HTTP://WWW.Example.COM:80/A?b#c", "http://a.b?q=http://c/", "s://h\nx/\ny"]
    got = spark.createDataFrame([(u,) for u in urls], "u string").select("u", warc.url_key(F.col("u"))).collect()
    assert [r[1] for r in got] == [plain_key(r[0]) for r in got]
    assert plain_key("http://www.example.com/a") == ",".join(reversed(urlsplit("http://www.example.com/a").netloc.split("."))) + ")/a"


def test_repeated_payloads_beyond_a_broadcast(spark, monkeypatch):
    """A payload that fills half of the rows goes by broadcast, others meet in a join."""
    rows = [(k, f"http://a/{k}", "hot" * 50 if k % 2 else f"pair {k // 4} " * 20) for k in range(400)]
    pages = spark.createDataFrame(rows, SCHEMA)

    def written():
        path = new_folder(spark, "warc-test")
        warc.write_archives(pages, path)
        return sorted((r.page_id, r.record_type, r.refers_to) for r in warc.read_archives(spark, path, payload=False).collect())

    small = written()
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(warc, "HOT_SHARE", 0.2)
    assert written() == small
    first = {}
    for k, _, h in rows:
        first.setdefault(h, k)
    assert small == [(k, "response" if first[h] == k else "revisit", None if first[h] == k else first[h]) for k, _, h in rows]


def test_a_damaged_payload_is_an_error():
    data = warc.record("response", 1, "http://a/", "2024-01-01T00:00:00Z", b"body", hashlib.sha256(b"body").hexdigest())
    assert warc.parsed(data)["payload"] == b"body"
    with pytest.raises(ValueError):
        warc.parsed(data.replace(b"body", b"bode"))


def test_empty_table(spark):
    path = new_folder(spark, "warc-test")
    assert warc.write_archives(spark.createDataFrame([], SCHEMA), path).count() == 0
    assert warc.read_archives(spark, path).count() == 0
    assert warc.Captures(path).find("com,a)/") == []

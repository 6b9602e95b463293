"""Readers of recording formats over small files made here, some of them damaged."""

import io
import sqlite3
import struct
import zipfile

import numpy as np
import pytest
import zstandard

from spanloom.sources import recordings

pytestmark = pytest.mark.filterwarnings("ignore")


def record(op, body):
    return struct.pack("<BQ", op, len(body)) + body


def text(s):
    return struct.pack("<I", len(s)) + s.encode()


def channel(ident, topic):
    return record(4, struct.pack("<HH", ident, 0) + text(topic) + text("json") + struct.pack("<I", 0))


def message(ident, number, data):
    return record(5, struct.pack("<HIQQ", ident, number, number * 10, number * 10 + 1) + data)


def test_mcap(spark, tmp_path):
    inner = message(1, 2, b"two") + message(9, 3, b"lost")
    packed = zstandard.ZstdCompressor().compress(inner)
    chunk = lambda kind, body: record(6, struct.pack("<QQQI", 0, 0, len(inner), 0) + text(kind) + struct.pack("<Q", len(body)) + body)
    whole = recordings.MCAP_MAGIC + channel(1, "/arm") + message(1, 1, b"one") + chunk("zstd", packed) + chunk("lz4", b"??") + recordings.MCAP_MAGIC
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "good.mcap").write_bytes(whole)
    (tmp_path / "cut.mcap").write_bytes(recordings.MCAP_MAGIC + channel(1, "/arm") + message(1, 1, b"one") + message(1, 2, b"two")[:-1])
    (tmp_path / "other.mcap").write_bytes(b"nothing of the kind")
    (tmp_path / "skipped.txt").write_bytes(whole)
    got = recordings.mcap_messages(spark, str(tmp_path)).collect()
    of = lambda name: [r for r in got if r.file.endswith(name)]
    assert [(r.topic, r.sequence, r.log_ns, bytes(r.data or b""), r.problem) for r in of("good.mcap")] == [("/arm", 1, 10, b"one", None), ("/arm", 2, 20, b"two", None), (None, 3, 30, b"lost", "no channel 9"), (None, None, None, b"", "chunk packed as lz4")]
    assert [bool(r.problem) for r in of("cut.mcap")] == [False, True] and [r.problem for r in of("other.mcap")] == ["ValueError: not an MCAP file"]
    assert not of("txt")


def test_bags(spark, tmp_path):
    with sqlite3.connect(tmp_path / "a.db3") as db:
        db.execute("CREATE TABLE topics (id INTEGER, name TEXT, type TEXT)")
        db.execute("CREATE TABLE messages (id INTEGER, topic_id INTEGER, timestamp INTEGER, data BLOB)")
        db.execute("INSERT INTO topics VALUES (1, '/cam', 'Image')")
        db.executemany("INSERT INTO messages VALUES (?, ?, ?, ?)", [(2, 1, 20, b"b"), (1, 1, 10, b"a"), (3, 7, 30, b"c")])
    db.close()
    (tmp_path / "bad.db3").write_bytes(b"not a database at all, but long enough to be read as one" * 20)
    got = recordings.bag_messages(spark, str(tmp_path)).collect()
    good = [r for r in got if r.file.endswith("a.db3")]
    assert [(r.id, r.topic, r.t_ns, bytes(r.data), r.problem) for r in good] == [(1, "/cam", 10, b"a", None), (2, "/cam", 20, b"b", None), (3, None, 30, b"c", "no topic 7")]
    assert [bool(r.problem) for r in got if r.file.endswith("bad.db3")] == [True]


def test_arrays(spark, tmp_path):
    np.savez(tmp_path / "a.npz", x=np.arange(6).reshape(2, 3), names=np.array(["p"]), one=np.float32(2.5))
    np.save(tmp_path / "b.npy", np.ones((1, 2, 2)))
    (tmp_path / "c.npy").write_bytes(b"?")
    got = recordings.array_values(spark, str(tmp_path)).collect()
    rows = {(r.file[-5:], r.name, r.row): r["values"] for r in got if not r.problem}
    assert rows == {("a.npz", "x", 0): [0, 1, 2], ("a.npz", "x", 1): [3, 4, 5], ("a.npz", "one", 0): [2.5], ("b.npy", None, 0): [1, 1, 1, 1]}
    assert sorted((r.file[-5:], r.name or "") for r in got if r.problem) == [("a.npz", "names"), ("c.npy", "")]


def test_zips_with_and_without_a_directory(spark, tmp_path):
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        z.writestr("one.txt", "first")
        z.writestr("two.txt", "second")
    data = held.getvalue()
    (tmp_path / "good.zip").write_bytes(data)
    (tmp_path / "cut.zip").write_bytes(data[: data.index(b"PK\x01\x02")])
    (tmp_path / "renamed.zip").write_bytes(data.replace(b"two.txt", b"own.txt", 1))
    got = {}
    for r in recordings.zip_members(spark, str(tmp_path)).collect():
        got.setdefault(r.file.rsplit("/")[-1], []).append((r.member, r.found_by, bool(r.problem)))
    assert got == {"good.zip": [("one.txt", "directory", False), ("two.txt", "directory", False)], "cut.zip": [("one.txt", "local", True), ("two.txt", "local", True)], "renamed.zip": [("one.txt", "directory", False), ("two.txt", "directory", True)]}

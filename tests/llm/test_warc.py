"""Archives: exact round trips, predicates, and files of other writers."""

import base64
import gzip
import hashlib
import zlib

import pyarrow as pa
import pytest

from loomwork.llm import warc
from loomwork.storage import new_path

ROWS = [
    (5, "http://a.example/x y?q=ü\r\nX: 1", "<p>same</p>", 1),
    (3, "http://a.example/", "<p>same</p>", 2),
    (9, None, "<p>same</p>", 3),
    (None, "http://b.example/", "<p>same</p>", 4),
    (4, "", None, 5),
    (6, "http://c.example/", "", 6),
    (7, "http://d.example/", "é" * 300_000, 7),
    (8, "http://e.example/", "alone\r\n\r\nWARC/1.1\r\n", 8),
    (8, "http://e.example/", "alone\r\n\r\nWARC/1.1\r\n", 8),
    (None, None, "no id", 9),
]
SCHEMA = "page_id long, url string, html string, payload_bytes int"


def b32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("min_bytes", [0, 5, 100])
@pytest.mark.parametrize("file_bytes", [100, 1 << 28])
def test_round_trip(spark, min_bytes, file_bytes):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = warc.archive_and_read(df, layout=warc.Layout(min_bytes=min_bytes, file_bytes=file_bytes)).collect()
    want = []
    for page, _, text, _ in ROWS:
        size = len((text or "").encode())
        same = [p for p, _, t, _ in ROWS if (t or "") == (text or "") and p is not None]
        first = min(same, default=None)
        again = size >= min_bytes and page != first
        want.append((page, size, b32(text), "revisit" if again else "response", first if again else None))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_predicates_and_payload(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    manifest = warc.write_warc(df, new_path(spark, "warc"))
    rows = warc.read_warc(spark, manifest=manifest)
    revisits = rows.where("record_type = 'revisit'")
    assert revisits.count() == 4 and revisits.where("payload is not null").count() == 0
    some = rows.where("target_uri like 'http://d%' and record_type in ('response', 'request')").collect()
    assert [r.payload.decode() for r in some] == ["é" * 300_000]
    assert rows.where("target_uri is null").count() == 2
    assert rows.where("record_type = 'response' and payload_bytes > 100").count() == 1
    slim = warc.read_warc(spark, manifest=manifest, payload="false")
    assert "payload" not in slim.columns
    assert sorted(r.payload_bytes for r in slim.collect()) == sorted(len((t or "").encode()) for _, _, t, _ in ROWS)


class Counting:
    def __init__(self, data):
        self.inner, self.n = pa.BufferReader(data), 0

    def read_at(self, n, at):
        self.n += n
        return self.inner.read_at(n, at)


def test_unwanted_payloads_are_not_decoded():
    import random

    noise = "".join(random.Random(1).choice("abcdefghijklmnop") for _ in range(400_000)).encode()
    data = b"".join(warc.gzip_member(warc.record(i, f"http://x/{i}", noise)) for i in range(5))
    file = Counting(data)
    none = list(warc.read_records(file, len(data), (warc.Wanted("warc-type", ("request",)),), True, True))
    assert none == [] and file.n < 30_000
    every = list(warc.read_records(Counting(data), len(data), (), True, True))
    assert [r[3] for r in every] == [noise] * 5


@pytest.mark.parametrize("pack", [lambda b: b, gzip.compress])
def test_files_of_other_writers(pack):
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: text/plain\r\nX-Long: a\r\n  b\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    plain = b"WARC/1.0\r\nwarc-type: resource\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    data = pack(info) + pack(warc.record(1, "http://x/", b"text")) + pack(plain)
    got = list(warc.read_records(pa.BufferReader(data), len(data), (), True, True))
    assert [(r[0]["warc-type"], r[2], r[3]) for r in got] == [("warcinfo", 5, b"hello"), ("response", 4, b"text"), ("resource", 0, b"")]
    assert got[0][0]["x-long"] == "a b"
    for broken in (data[: len(pack(info)) + 40], b"WARC" + data, data[:10]):
        with pytest.raises((ValueError, zlib.error)):
            list(warc.read_records(pa.BufferReader(broken), len(broken), (), True, True))


def test_members_are_gzip():
    data = warc.record(1, "http://x/", b"text")
    assert gzip.decompress(warc.gzip_member(data) + warc.gzip_member(b"")) == data


def test_wrong_digest():
    data = warc.record(1, "http://x/", b"text").replace(b"text\r", b"TEXT\r")
    with pytest.raises(ValueError, match="digest"):
        list(warc.read_records(pa.BufferReader(data), len(data), (), True, True))
    assert len(list(warc.read_records(pa.BufferReader(data), len(data), (), True, False))) == 1


def test_empty(spark):
    assert warc.archive_and_read(spark.createDataFrame([], SCHEMA)).count() == 0

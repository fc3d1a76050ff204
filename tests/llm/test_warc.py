"""The WARC source: round trips, foreign archives, what is pushed down and what is decoded."""

import base64
import gzip
import hashlib
import os

import pytest

from raresight.llm import warc
from raresight.llm.common import ship

PAGES = "page_id long, url string, html string"


def expected(rows, min_bytes=0):
    by = {}
    for k, _, h in rows:
        by.setdefault((h or "").encode(), []).append(k)
    out = []
    for k, u, h in rows:
        data = (h or "").encode()
        first = max((x for x in by[data] if x is not None), default=None)
        revisit = len(data) >= min_bytes and first is not None and k != first
        out.append((k, u, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", first if revisit else None, None if revisit else data))
    return sorted(out, key=repr)


def back(spark, path, **options):
    rows = warc.read_warc(spark, path, **options).select(
        warc.key_of("record_id").alias("k"), "target_uri", "payload_length", warc.bare_digest("payload_digest").alias("d"), "record_type", warc.key_of("refers_to").alias("r"), "payload").collect()
    return sorted(((r.k, r.target_uri, r.payload_length, r.d, r.record_type, r.r, None if r.payload is None else bytes(r.payload)) for r in rows), key=repr)


def sample():
    rows = [(i, f"http://a/{i}", f"<p>page {i} é</p>" * (1 + i % 7)) for i in range(60)]
    rows += [(100 + i, "http://b/", "same") for i in range(30)] + [(200 + i, None, None if i % 2 else "") for i in range(9)]
    rows += [(300, "http://long/", "z\r\n\r\nWARC/1.1\r\n" * 200_000), (None, "u", "same"), (None, "v", "only here"), (129, "http://again/", "same"), (-5, "u", "neg")]
    return rows


@pytest.mark.parametrize("level", [0, 6])
@pytest.mark.parametrize("min_bytes", [0, 5])
def test_round_trip(spark, level, min_bytes):
    ship(spark)
    rows = sample()
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], PAGES + ", sha string, `first` string")
    path = warc.archive(pages.repartition(3), level=level, min_bytes=min_bytes)
    assert back(spark, path) == expected(rows, min_bytes)
    assert back(spark, path, partition_bytes=1) == expected(rows, min_bytes)


def test_empty(spark):
    ship(spark)
    path = warc.archive(spark.createDataFrame([], PAGES))
    assert back(spark, path) == []
    assert warc.read_warc(spark, path, ["record_id"]).count() == 0


def test_unsafe_header_values(spark):
    ship(spark)
    path = warc.archive(spark.createDataFrame([(1, "http://a/\r\nWARC-Type: x\n", "h")], PAGES))
    row = warc.read_warc(spark, path).first()
    assert row.target_uri == "http://a/%0D%0AWARC-Type: x%0A" and row.record_type == "response" and row.payload == b"h"


def test_foreign_archive(spark, tmp_path):
    """Members without lengths, a plain file, other record types; no manifest, so the folder is listed."""
    ship(spark)

    def record(kind, n, block, extra=""):
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nwarc-record-id: <urn:x:{n}>\r\n{extra}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    html = os.urandom(3 << 20)
    all_of = [record("warcinfo", 0, b"software: x\r\n"), record("response", 1, b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n" + html, "Content-Type: application/http; msgtype=response\r\n"),
              record("resource", 2, b"block", "Content-Type: text/plain\r\n"), record("metadata", 3, b"")]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in all_of))
    (tmp_path / "b.warc").write_bytes(b"".join(all_of))
    (tmp_path / "c.txt").write_text("not an archive")
    df = warc.read_warc(spark, str(tmp_path))
    found = sorted((r.record_id, r.record_type, bytes(r.payload)) for r in df.collect())
    once = [("<urn:x:0>", "warcinfo", b"software: x\r\n"), ("<urn:x:1>", "response", html), ("<urn:x:2>", "resource", b"block"), ("<urn:x:3>", "metadata", b"")]
    assert found == sorted(once * 2)
    assert df.filter("record_type = 'resource' and content_length > 4").count() == 2
    assert warc.read_warc(spark, str(tmp_path / "b.warc")).count() == 4


def test_pushdown(spark):
    ship(spark)
    pages = spark.createDataFrame([(i, f"http://h{i % 3}/{i}", "same" if i % 2 else f"p{i}") for i in range(40)], PAGES)
    path = warc.archive(pages)
    df = warc.read_warc(spark, path)
    for condition, n in [("record_type = 'revisit'", 19), ("record_type in ('response', 'x') and target_uri like 'http://h0/%'", 8), ("refers_to is null and payload_length >= 3", 16),
                         ("refers_to <=> null", 21), ("payload_length < 3 or target_uri is null", 5), ("record_type is not null and length(payload) = 4", 1), ("record_type = 'none'", 0)]:
        assert df.filter(condition).count() == n, condition
    assert "record_type" in df.filter("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()


def read_here(folder, filters, columns):
    """The reader's own steps, in this process."""
    from pyspark.sql import types as T

    reader = warc.WarcReader(T.StructType([T.StructField(c, T.StringType()) for c in columns]), {"path": folder})
    left = list(reader.pushFilters(filters))
    return left, [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]


def test_skips_unwanted_payloads(spark, monkeypatch):
    from pyspark.sql.datasource import EqualTo, StringContains

    ship(spark)
    path = warc.archive(spark.createDataFrame([(i, "u", f"page {i}") for i in range(20)] + [(i, "u", "same") for i in range(50, 60)], PAGES))
    opened = []
    block = warc.Record.block
    monkeypatch.setattr(warc.Record, "block", lambda self: opened.append(1) or block(self))
    left, rows = read_here(path, [EqualTo(("record_type",), "revisit"), StringContains(("target_uri",), "u")], ["record_id", "payload"])
    assert len(rows) == 9 and len(left) == 1 and not opened
    assert len(read_here(path, [], ["record_id"])[1]) == 30 and not opened
    assert len(read_here(path, [EqualTo(("record_id",), warc.URN % 3)], ["payload"])[1]) == 1 and len(opened) == 1


def test_files_of_failed_attempts_are_not_read(spark, tmp_path):
    ship(spark)
    path = warc.archive(spark.createDataFrame([(1, "u", "x")], PAGES), path=str(tmp_path / "w"))
    (tmp_path / "w" / "left.warc").write_bytes(b"half a rec")
    assert warc.read_warc(spark, path).count() == 1
    warc.archive(spark.createDataFrame([(2, "u", "y")], PAGES), path=path)
    assert warc.read_warc(spark, path).count() == 2


def test_files_without_a_wanted_type_are_not_planned(spark):
    from pyspark.sql.datasource import EqualTo

    ship(spark)
    path = warc.archive(spark.createDataFrame([(i, "u", f"{i}") for i in range(8)], PAGES).repartition(4))
    reader = warc.WarcReader(spark.createDataFrame([], "record_id string").schema, {"path": path})
    assert list(reader.pushFilters([EqualTo(("record_type",), "revisit")])) == []
    assert [p.paths for p in reader.partitions()] == [[]]

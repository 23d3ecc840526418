import gzip
import io
import zlib

import pytest
from pyspark.sql import functions as F

from waybill.llm import common, files, warc

BIG = "<p>" + "y" * 200
PAGES = [
    (1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, None, "z" * 99), (4, "http://a/4", "z" * 99),
    (5, "http://a/5", None), (6, "http://a/6", ""), (7, "http://a/7\r\nX: y", "é" * 60), (2, "http://a/2", BIG),
    (None, "http://a/9", BIG), (8, "http://b/8", "WARC/1.1\r\n\r\n" + "q" * 100000),
]


@pytest.fixture
def archive(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    warc.write_archive(pages, str(tmp_path / "warc"))
    return str(tmp_path / "warc")


def test_round_trip(spark, archive):
    rows = warc.read_archive(spark, archive).collect()
    assert len(rows) == len(PAGES)
    kept = {r.record_id: bytes(r.payload).decode() for r in rows if r.payload is not None}
    for page_id, _, html in PAGES:
        if page_id not in (2, None):
            assert kept[f"<urn:page:{page_id}>"] == (html or "")
    got = sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_bytes) for r in
                 warc.pages_of(warc.read_archive(spark, archive)).collect())
    again = lambda i: i in (2, None)
    want = sorted(
        (str(i), "revisit" if again(i) else "response", 1 if again(i) else None, len((h or "").encode()))
        for i, _, h in PAGES
    )
    assert got == want


def test_headers_are_judged_before_payloads(spark, archive):
    rows = warc.read_archive(spark, archive)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    some = rows.filter((F.col("record_type") == "revisit") & F.col("target_uri").startswith("http://a/"))
    assert some.count() == 3 and "Filter (" not in plan(some)
    assert rows.filter("record_id in ('<urn:page:4>', '<urn:page:8>')").count() == 2
    assert rows.filter("payload_bytes > 1000").count() == 1
    bare = warc.read_archive(spark, archive, payload=False)
    assert bare.count() == len(PAGES) and bare.filter("payload is not null").isEmpty()


def test_unwanted_blocks_are_not_decoded():
    row = {"record_type": "response", "record_id": "<x>", "refers_to": None, "target_uri": None,
           "payload_digest": "0", "payload_bytes": 3, "payload": b"abc"}
    broken = warc.encode_record(row).replace(b"\x1f\x8b", b"\0\0")
    assert list(warc.read_records(io.BytesIO(broken), lambda r: False)) == []
    with pytest.raises(Exception):
        list(warc.read_records(io.BytesIO(broken)))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(b"no archive\r\n")))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(warc.encode_record(row)[:-20])))


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archive(pages, str(tmp_path / "none"))
    assert warc.pages_of(warc.read_archive(spark, str(tmp_path / "none"))).count() == 0


def foreign(kind, uri, block, content_type="application/http; msgtype=response"):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{uri}>\r\nWARC-Target-URI: <{uri}>\r\n"
    head += f"WARC-Payload-Digest: sha1:ABC\r\nContent-Type: {content_type}\r\nContent-Length: {len(block)}\r\n"
    return head.encode() + b"\r\n" + block + b"\r\n\r\n"


def test_archives_of_other_writers(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n%s\r\n%s"
    chunks = b"4\r\nWiki\r\n6;a=b\r\npedia \r\n0\r\n\r\n"
    records = [
        foreign("warcinfo", "info", b"software: other", "application/warc-fields"),
        foreign("request", "r", b"GET / HTTP/1.1\r\n\r\n", "application/http; msgtype=request"),
        foreign("response", "plain", http % (b"", b"<p>hi")),
        foreign("response", "chunked", http % (b"Transfer-Encoding: chunked\r\n", chunks)),
        foreign("response", "gzip", http % (b"content-encoding: GZIP\r\n", gzip.compress(b"zipped"))),
        foreign("response", "deflate", http % (b"Content-Encoding: deflate\r\n", zlib.compress(b"z")[2:-4])),
        foreign("response", "lies", http % (b"Content-Encoding: gzip\r\n", b"not coded")),
        foreign("response", "dns:x", b"1.2.3.4", "text/dns"),
        foreign("resource", "image", b"\x89PNG", "image/png"),
    ]
    bodies = {"plain": b"<p>hi", "chunked": b"Wikipedia ", "gzip": b"zipped", "deflate": b"z", "lies": b"not coded",
              "dns:x": b"1.2.3.4", "image": b"\x89PNG"}
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "deep" / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    (tmp_path / "deep" / "c.txt").write_bytes(b"no archive")
    rows = warc.read_archive(spark, str(tmp_path))
    got = [(r.target_uri, bytes(r.payload)) for r in rows.collect() if r.payload is not None]
    assert sorted(got) == sorted([*bodies.items()] * 2)
    assert rows.count() == 2 * len(records) and {r.payload_digest for r in rows.collect()} == {"ABC"}
    for file in ("a.warc", "deep/b.warc.gz"):
        one = warc.read_archive(spark, str(tmp_path / file))
        assert one.filter("record_type = 'resource'").first().payload_bytes == 4
        assert one.filter("record_type = 'response' and target_uri = 'chunked'").count() == 1
    with pytest.raises(Exception):
        warc.read_archive(spark, str(tmp_path / "none")).collect()
    assert warc.read_archive(spark, str(tmp_path / "deep" / "c.txt").replace("c.txt", "")).count() == len(records)


def test_unwanted_members_are_passed_over():
    record = {"record_type": "response", "record_id": "<x>", "refers_to": None, "target_uri": "u",
              "payload_digest": "0", "payload_bytes": 1 << 20, "payload": b"abcd" * (1 << 18)}
    members = b"".join(gzip.compress(warc.encode_record(record | {"record_id": f"<{i}>"})) for i in range(5))
    source = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(members)))
    found = list(warc.read_records(source, lambda row: row["record_id"] == "<3>"))
    assert [(row["record_id"], len(row["payload"])) for row in found] == [("<3>", 1 << 20)]


def test_paths_belong_to_the_default_store(spark, tmp_path):
    assert common.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://elsewhere/")
    conf.set("fs.viewfs.mounttable.elsewhere.link./shared", f"file://{tmp_path}")
    try:
        assert common.qualified(spark, "/shared/x") == "viewfs://elsewhere/shared/x"
        assert common.qualified(spark, f"file://{tmp_path}") == f"file:{tmp_path}"
        # Not a store that tasks can open themselves: stopped, not written to a local disk.
        with pytest.raises(Exception):
            files.open_store(common.qualified(spark, "/shared/x"))
    finally:
        conf.set("fs.defaultFS", before or "file:///")

"""Web archives (WARC 1.1) as a data source: `spark.read.format("warc").load(folder)`.

Record headers are plain text; the block of a response is an HTTP message with a gzip-coded body, so
a reader parses headers first and seeks past the blocks of records that it does not want without
reading or inflating them. Equality, membership and prefix predicates on the record type and on
columns that headers hold are pushed down to that point. Bodies of equal payloads are stored once;
later records refer to the first one.

Archives of other writers are read as well: a folder without our manifest gives its `.warc` and
`.warc.gz` files, at any depth, and a path may name one such file. Records that are compressed one by
one are inflated in turn, those that are not wanted without keeping anything. HTTP bodies may be
chunked, or coded by gzip or deflate; other codings are returned as stored. A file is read by one task.
"""

from __future__ import annotations

import gzip
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringStartsWith,
    WriterCommitMessage,
)

from waybill.llm import files
from waybill.llm.common import free_name, qualified

#: An archive file is closed at this size, and files are read in bins of up to this size.
FILE_BYTES = 128 << 20
#: Payloads from this size on are stored once.
REVISIT_BYTES = 100
#: The pages carry no fetch time; a fixed one keeps archives equal between runs.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = (
    "record_type string, record_id string, refers_to string, target_uri string,"
    " payload_digest string, payload_bytes bigint, payload binary"
)
# The header of each column that can be judged before the block is read.
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "refers_to": "warc-refers-to",
    "target_uri": "warc-target-uri",
    "payload_digest": "warc-payload-digest",
}
#: Record types whose block is, or holds, a payload of its own.
WITH_PAYLOAD = ("response", "resource", "conversion")
ENDINGS = (".warc", ".warc.gz")
_ARROW = pa.schema(
    [(name, pa.string()) for name in HEADERS]
    + [("payload_bytes", pa.int64()), ("payload", pa.binary())]
)
_BATCH_BYTES = 4 << 20


def _line(name: str, value: str | None) -> str:
    if value is None:
        return ""
    return f"{name}: {value.replace(chr(13), '%0D').replace(chr(10), '%0A')}\r\n"


def encode_record(row: dict) -> bytes:
    """One record. `payload` None stands for a revisit: headers only."""
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    body = b""
    if row["payload"] is not None:
        body = gzip.compress(row["payload"], 1, mtime=0)
        http += f"Content-Encoding: gzip\r\nContent-Length: {len(body)}\r\n"
    block = http.encode() + b"\r\n" + body
    head = (
        "WARC/1.1\r\n"
        + _line("WARC-Type", row["record_type"])
        + _line("WARC-Record-ID", row["record_id"])
        + _line("WARC-Date", DATE)
        + _line("WARC-Target-URI", row["target_uri"])
        + _line("WARC-Payload-Digest", f"sha256:{row['payload_digest']}")
        + _line("X-Payload-Length", str(row["payload_bytes"]))
        + (_line("WARC-Profile", PROFILE) if row["record_type"] == "revisit" else "")
        + _line("WARC-Refers-To", row["refers_to"])
        + "Content-Type: application/http; msgtype=response\r\n"
        + f"Content-Length: {len(block)}\r\n\r\n"
    )
    return head.encode() + block + b"\r\n\r\n"


def _headers(source) -> dict[str, str] | None:
    """The named fields of the next record; None at the end of the file."""
    line = source.readline()
    while line in (b"\r\n", b"\n"):
        line = source.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    fields = {}
    while (line := source.readline()) not in (b"\r\n", b"\n"):
        if not line:
            raise ValueError("the file ends inside a record's headers")
        name, _, value = line.decode(errors="replace").partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields


def _unchunked(body: bytes) -> bytes:
    """The data of a chunked body; what is there of one that was cut short."""
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        try:
            size = int(body[at:end].partition(b";")[0], 16)
        except ValueError:
            return body if at == 0 else b"".join(out)  # the archive's writer took the chunks apart
        if size == 0:
            break
        out.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size + 2
    return b"".join(out)


def _body(block: bytes) -> bytes:
    """The payload of an HTTP message."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower()] = value.strip().lower()
    if b"chunked" in fields.get(b"transfer-encoding", b""):
        body = _unchunked(body)
    windows = {b"gzip": (31,), b"x-gzip": (31,), b"deflate": (15, -15)}
    for bits in windows.get(fields.get(b"content-encoding", b""), ()):
        coded = zlib.decompressobj(bits)
        try:
            return coded.decompress(body)
        except zlib.error:
            continue  # not what the header says, or deflate without its wrapper
    return body


def _payload(kind: str | None, fields: dict[str, str], block: bytes) -> bytes:
    http = kind == "response" and fields.get("content-type", "application/http").startswith("application/http")
    return _body(block) if http else block


def _values(fields: dict[str, str]) -> dict:
    row = {name: fields.get(header) for name, header in HEADERS.items()}
    if row["payload_digest"]:
        row["payload_digest"] = row["payload_digest"].rpartition(":")[2]
    if row["target_uri"]:
        row["target_uri"] = row["target_uri"].removeprefix("<").removesuffix(">")
    length = fields.get("x-payload-length")
    return row | {"payload_bytes": int(length) if length else None}


def read_records(source, wanted=lambda row: True, payload: bool = True) -> Iterator[dict]:
    """Records whose header values are `wanted`; the blocks of others are seeked past, unread."""
    while (fields := _headers(source)) is not None:
        row, length = _values(fields), int(fields["content-length"])
        if not wanted(row):
            source.seek(length, 1)
            continue
        row["payload"] = None
        if payload and row["record_type"] in WITH_PAYLOAD:
            block = source.read(length)
            if len(block) < length:
                raise ValueError("the file ends inside a record's block")
            row["payload"] = _payload(row["record_type"], fields, block)
            if row["payload_bytes"] is None:
                row["payload_bytes"] = len(row["payload"])
            elif row["payload_bytes"] != len(row["payload"]):
                raise ValueError(f"{row['record_id']}: the payload is not of the length that its headers state")
        else:
            source.seek(length, 1)
        yield row


def _holds(row: dict, test: Filter) -> bool:
    value = row[test.attribute[0]]
    match test:
        case IsNotNull():
            return value is not None
        case IsNull():
            return value is None
        case EqualNullSafe():
            return value == test.value
        case EqualTo():
            return value is not None and value == test.value
        case In():
            return value is not None and value in test.value
        case StringStartsWith():
            return value is not None and value.startswith(test.value)
    raise TypeError(test)


def opened(store, path: str) -> io.BufferedReader:
    """An archive's records, inflated where its first bytes say that they are compressed."""
    source = files.open_read(store, path)
    if source.peek(2)[:2] != b"\x1f\x8b":
        return source
    return io.BufferedReader(gzip.GzipFile(fileobj=source), 1 << 20)


class FilePartition(InputPartition):
    def __init__(self, names: list[str]):
        self.names = names


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() != "false"
        self.tests: list[Filter] = []

    def pushFilters(self, filters):  # noqa: N802 - the name is Spark's
        """Keeps what headers can answer; yields the rest back to Spark."""
        kinds = (EqualTo, EqualNullSafe, In, IsNotNull, IsNull, StringStartsWith)
        for test in filters:
            if isinstance(test, kinds) and len(test.attribute) == 1 and test.attribute[0] in HEADERS:
                self.tests.append(test)
            else:
                yield test

    def partitions(self):
        ours = files.has_manifest(self.path)
        entries = files.published(self.path) if ours else files.listed(self.path, ENDINGS)
        bins = files.binned(entries, FILE_BYTES)
        return [FilePartition([entry["name"] for entry in group]) for group in bins]

    def read(self, partition):
        if partition is None:
            return
        store, folder = files.open_store(self.path)
        wanted = lambda row: all(_holds(row, test) for test in self.tests)
        rows, size = [], 0
        for name in partition.names:
            with opened(store, f"{folder}/{name}".rstrip("/")) as source:
                for row in read_records(source, wanted, self.payload):
                    rows.append(row)
                    size += len(row["payload"] or b"") + 500
                    if size >= _BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


class Written(WriterCommitMessage):
    def __init__(self, entries: list[dict]):
        self.entries = entries


class WarcWriter(DataSourceArrowWriter):
    """Each task attempt writes files of its own; the commit lists those of the attempts that count."""

    def __init__(self, options):
        self.path = options["path"]

    def write(self, iterator):
        store, folder = files.open_store(self.path)
        store.create_dir(folder, recursive=True)
        entries, out = [], None
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or entries[-1]["bytes"] >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    entries.append({"name": f"{uuid.uuid4().hex}.warc", "bytes": 0, "records": 0})
                    out = store.open_output_stream(f"{folder}/{entries[-1]['name']}")
                record = encode_record(row)
                out.write(record)
                entries[-1]["bytes"] += len(record)
                entries[-1]["records"] += 1
        if out is not None:
            out.close()
        return Written(entries)

    def commit(self, messages):
        files.publish(self.path, [entry for message in messages if message for entry in message.entries])

    def abort(self, messages):
        files.discard(self.path, [entry["name"] for message in messages if message for entry in message.entries])


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def page_urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def to_records(pages: DataFrame) -> DataFrame:
    """A record per page (page_id, url, html), with the payloads of revisits left out.

    Of equal payloads of at least 100 bytes the smallest page_id is the response; rows that repeat
    that id are responses as well. A null html is an empty payload, a null url leaves the header out,
    and a null id is never the smallest. Only (digest, id) pairs are aggregated, and combined before
    the shuffle; the join back may be split where one payload holds many rows.
    """
    payload = F.coalesce(F.encode(F.col("html"), "UTF-8"), F.lit(b""))
    plain = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"payload_digest": F.sha2("payload", 256), "payload_bytes": F.length("payload").cast("bigint")}
    )
    firsts = (
        plain.filter(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy(F.col("payload_digest").alias("digest"))
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .filter("n > 1 AND first_id IS NOT NULL")
    )
    joined = plain.join(firsts, F.col("payload_digest") == F.col("digest"), "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        page_urn(F.col("page_id")).alias("record_id"),
        F.when(again, page_urn(F.col("first_id"))).alias("refers_to"),
        F.col("url").alias("target_uri"),
        "payload_digest",
        "payload_bytes",
        F.when(~again, F.col("payload")).alias("payload"),
    )


def write_archive(pages: DataFrame, path: str) -> None:
    """Write every page as a record under `path`; runs a job."""
    register(pages.sparkSession)
    to_records(pages).write.format("warc").mode("append").save(qualified(pages.sparkSession, path))


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """All records under `path`; `payload=False` decodes none of the payloads."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(qualified(spark, path))


def page_id(urn: Column) -> Column:
    """The id inside a page's record id; null for pages without one."""
    return F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1).try_cast("bigint")


def pages_of(records: DataFrame) -> DataFrame:
    """Page figures from records: those of responses from the decoded payload, of revisits from headers."""
    decoded = F.col("payload").isNotNull()
    length, digest = free_name(records, "length"), free_name(records, "digest")
    return records.withColumns(
        {
            length: F.when(decoded, F.length("payload").cast("bigint")).otherwise(F.col("payload_bytes")),
            digest: F.when(decoded, F.sha2("payload", 256)).otherwise(F.col("payload_digest")),
        }
    ).select(
        page_id(F.col("record_id")).alias("page_id"),
        F.col(length).alias("payload_bytes"),
        F.col(digest).alias("payload_digest"),
        "record_type",
        page_id(F.col("refers_to")).alias("refers_to"),
    )

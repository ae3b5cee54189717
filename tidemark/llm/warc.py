"""WARC archives: writing captures, reading them back, assembling transactions."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read_files, staged, write_files

END = b"\r\n\r\n"
VERSION = b"WARC/1.1"
DATE = "2024-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, fields: dict[str, str], block: bytes) -> bytes:
    """A record without the two line ends that follow it."""
    lines = [VERSION, b"WARC-Type: " + kind.encode()]
    lines += [f"{k}: {v}".encode() for k, v in fields.items()]
    lines.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(lines) + END + block


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of an archive: header fields, in lower case, and block.  Blocks may hold anything; lengths decide."""
    at = 0
    while data.startswith(VERSION, at):
        end = data.index(END, at)
        fields = dict(line.split(": ", 1) for line in data[at:end].decode().split("\r\n")[1:])
        fields = {k.lower(): v for k, v in fields.items()}
        at = end + len(END) + int(fields["content-length"])
        yield fields, data[end + len(END) : at]
        at += len(END)


def one_line(value: str | None) -> str:
    """A URL fit for a header line."""
    return "".join(c if c > " " else "%%%02X" % ord(c) for c in value or "")


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, file_bytes: int = 1 << 24) -> None:
    """Write request, response or revisit, and metadata records of `pages` (page_id, url, html) under `path`.

    Of pages with equal payloads of at least `least_bytes`, those with the smallest
    page_id are responses and the others revisits of it.  The groups with more than
    one page are staged: while they are few, pages find theirs without being moved.
    Files are gzipped and hold about `file_bytes` of records.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload")
    )
    keys = rows.filter(F.length("payload") >= least_bytes).select("page_id", F.sha2("payload", 256).alias("sha"))
    firsts = keys.groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = staged(firsts.filter("n > 1").select("sha", "first"), "payloads")
    found = rows.withColumn("sha", F.when(F.length("payload") >= least_bytes, F.sha2("payload", 256))).join(shared, "sha", "left")
    refers = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for page_id, url, payload, first in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers"))):
                for block in _capture(f"{part}-{n}", page_id, url, payload, first):
                    held.append(block)
                    size += len(block)
                n += 1
                if size >= file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([END.join(held)], pa.binary())], ["blob"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([END.join(held)], pa.binary())], ["blob"])

    blobs = found.select("page_id", "url", "payload", refers.alias("refers")).mapInArrow(archive, "blob binary")
    write_files(blobs, path, END.decode(), "gzip")


def _capture(name: str, page_id: int | None, url: str | None, payload: bytes, refers: int | None) -> Iterator[bytes]:
    """The three records of a page; request and metadata name the response they are concurrent to."""
    ids = {kind: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}/{kind}')}>" for kind in ("response", "request", "metadata")}
    where = one_line(url)
    common = {"WARC-Date": DATE, **({"WARC-Target-URI": where} if where else {})}
    host = where.split("//", 1)[-1].split("/", 1)[0].split("?", 1)[0]
    yield record("request", {"WARC-Record-ID": ids["request"], "WARC-Concurrent-To": ids["response"], **common, "Content-Type": "application/http; msgtype=request"}, f"GET {where or '/'} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode())
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    fields = {"WARC-Record-ID": ids["response"], **common, "Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": f"sha1:{digest(payload)}"}
    if refers is None:
        yield record("response", fields, head + payload)
    else:
        fields |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "X-Refers-To-Page": str(refers)}
        yield record("revisit", fields, head)
    about = f"page: {'' if page_id is None else page_id}\r\nurl: {'' if url is None else base64.b64encode(url.encode()).decode()}\r\npayload-bytes: {len(payload)}\r\n"
    yield record("metadata", {"WARC-Record-ID": ids["metadata"], "WARC-Concurrent-To": ids["response"], **common, "Content-Type": "application/warc-fields"}, about.encode())


RECORD = (
    "capture string, kind string, record_id string, target string, page_id long, url string, request string, payload binary, "
    "payload_bytes long, payload_digest string, refers_to long"
)


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record of the archives under `path`; `payloads=False` leaves the bodies out."""
    names = [x.split(" ")[0] for x in RECORD.split(", ")]
    types = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                data, rows = content.as_py(), []
                for fields, block in parse_records(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                    rows.append(_row(fields, block, payloads))
                    if len(rows) >= 1000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return read_files(spark, path).mapInArrow(parse, RECORD)


def _row(fields: dict[str, str], block: bytes, payloads: bool) -> tuple:
    kind, own = fields["warc-type"], fields["warc-record-id"]
    page_id = url = request = payload = size = refers = None
    if kind == "request":
        request = block.decode("utf-8", "replace")
    elif kind == "metadata":
        about = dict(line.split(": ", 1) for line in block.decode().split("\r\n") if line)
        page_id = int(about["page"]) if about["page"] else None
        url = base64.b64decode(about["url"]).decode() if about["url"] else None
        size = int(about["payload-bytes"])
    else:
        payload = block[block.index(END) + len(END) :] if kind == "response" else None
        size = None if payload is None else len(payload)
        refers = int(fields["x-refers-to-page"]) if "x-refers-to-page" in fields else None
        # The digest of what was read, where there is a body; a revisit only has the one that its header states.
        sha = digest(payload) if payload is not None else fields["warc-payload-digest"].removeprefix("sha1:")
        return own, kind, own, fields.get("warc-target-uri"), None, None, None, payload if payloads else None, size, sha, refers
    return fields["warc-concurrent-to"], kind, own, fields.get("warc-target-uri"), page_id, url, request, None, size, None, None


def captures(records: DataFrame) -> DataFrame:
    """One row per capture: its response or revisit, joined with request and metadata through the id they are concurrent to.

    A capture without request or metadata keeps nulls there; a request or metadata
    record without its response has no capture.
    """
    requests = records.filter("kind = 'request'").select("capture", F.struct("record_id", "target", F.col("request").alias("text")).alias("request"))
    metadata = records.filter("kind = 'metadata'").select("capture", F.struct("record_id", "page_id", "url", "payload_bytes").alias("metadata"))
    responses = records.filter("kind IN ('response', 'revisit')").select(
        "capture", F.struct("record_id", "kind", "target", "payload", "payload_bytes", "payload_digest", "refers_to").alias("response")
    )
    return responses.join(requests, "capture", "left").join(metadata, "capture", "left")


def capture_digests(found: DataFrame) -> DataFrame:
    """page_id, payload_bytes (of a revisit: as its metadata state), payload_digest, record_type, refers_to."""
    return found.select(
        F.col("metadata.page_id").alias("page_id"),
        F.coalesce("response.payload_bytes", "metadata.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.kind").alias("record_type"),
        F.col("response.refers_to").alias("refers_to"),
    )

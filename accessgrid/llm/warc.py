"""Legacy archives to WARC: version-specific ARC headers in, WARC records with identifiers out.

ARC files start with a version block that says how the header lines of their records look; each
line ends with the length of the content that follows.  The converter reads those, and makes of each
record a WARC record: an identifier from file and offset, an ISO date from the 14 digits, SHA-1
digests, and the type `revisit` where a record with an equal payload comes first.

Archives are written by Spark's text sink, gzipped, a row for each file, so no task holds more than
ARCHIVE_BYTES (or one record, if that is longer) and a lost executor's files are written again.
"""
from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accessgrid.llm.common import scratch

ARCHIVE_BYTES = 8_000_000
#: Payloads from this length on are replaced by a revisit if an earlier record has the same.
MIN_REVISIT_BYTES = 0
#: Pages carry no time of their own.
CAPTURED = "20000101000000"
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
RECORD = (
    "arc string, offset long, version int, url string, date string, mime string, page_id long, "
    "head binary, payload binary, payload_bytes long, payload_digest string"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def arc_date(digits: str) -> str:
    """14 digits as ISO 8601; missing digits count as the earliest time."""
    d = digits[:14] + "00000101000000"[len(digits[:14]) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(arc: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{arc}#{offset}')}>"


def _target(url: str | None) -> str:
    """Header lines are split at white space, so a URL must not hold any; none is `unknown:`."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or "unknown:"


def _http_head(page_id: int | None, length: int) -> bytes:
    own = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {length}\r\n\r\n".encode()


def _packed(records: Iterator[tuple[bytes, ...]], start: bytes, between: bytes, limit: int) -> Iterator[bytes]:
    """Files of about `limit` bytes; what ends the last record is the sink's line separator."""
    held, size = [], 0
    for record in records:
        if held and size + len(record) > limit:
            yield between.join([start, *held])
            held, size = [], 0
        held.append(record)
        size += len(record)
    if held:
        yield between.join([start, *held])


def _batches(values: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    for v in values:
        yield pa.RecordBatch.from_pydict({"value": pa.array([v], pa.binary())})


def _write_files(files: DataFrame, path: str, separator: str) -> str:
    text = files.select(F.col("value").cast("string").alias("value"))
    sink = text.write.option("lineSep", separator).option("maxRecordsPerFile", 1)
    sink.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)
    return path


def write_arc(pages: DataFrame, path: str, version: int, limit: int = ARCHIVE_BYTES) -> str:
    """Pages (page_id, url, html) as ARC files of the version; null html is an empty payload."""
    fields = ARC_FIELDS[version]
    block = f"{version} 0 accessgrid\n{fields}\n".encode()
    line = f"filedesc://pages.arc 0.0.0.0 {CAPTURED} text/plain".encode()
    line += b" 200 - - 0 pages.arc" if version == 2 else b""
    start = line + f" {len(block)}\n".encode() + block

    def rows(batches):
        for batch in batches:
            for page_id, url, html in zip(*(batch.column(i).to_pylist() for i in range(3))):
                content = _http_head(page_id, len(html or b"")) + (html or b"")
                more = f" 200 {hashlib.md5(content).hexdigest()} - 0 pages.arc" if version == 2 else ""
                yield f"{_target(url)} 0.0.0.0 {CAPTURED} text/html{more} {len(content)}\n".encode() + content

    slim = pages.select("page_id", "url", F.col("html").cast("binary").alias("html"))
    files = slim.mapInArrow(lambda b: _batches(_packed(rows(b), start, b"\n", limit)), "value binary")
    return _write_files(files, path, "\n")


def parse_arc(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(version, offset, header fields by lower-case name, content) of each record but the version block.

    The field names come from the file's own version block.  A URL may hold spaces: the other
    fields are taken from the right.  A length that runs beyond the file is an error.
    """
    data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
    at, names, version = 0, None, 0
    while True:
        while data[at : at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            return
        end = data.index(b"\n", at)
        head = data[at:end].decode("utf-8", "replace").rstrip("\r")
        length = int(head.rsplit(" ", 1)[1])
        content = data[end + 1 : end + 1 + length]
        if len(content) < length:
            raise ValueError(f"record at {at} declares {length} bytes, {len(content)} are left")
        if names is None:
            if not head.startswith("filedesc:"):
                raise ValueError("an ARC file must start with its version block")
            first, second = content.decode("utf-8", "replace").split("\n")[:2]
            version, names = int(first.split()[0]), second.lower().split()
        else:
            yield version, at, dict(zip(names, head.rsplit(" ", len(names) - 1))), content
        at = end + 1 + length


def _split_http(content: bytes) -> tuple[bytes, bytes]:
    head, mark, body = content.partition(b"\r\n\r\n")
    return (head + mark, body) if content.startswith(b"HTTP/") and mark else (b"", content)


def _field(head: bytes, name: bytes) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name) + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace").strip() if found else None


def read_arc(spark: SparkSession, paths: list[str], payloads: bool = True) -> DataFrame:
    """A row for each record of the ARC files; without payloads only their lengths and digests."""

    def rows(batches):
        for batch in batches:
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                out = []
                for version, offset, fields, content in parse_arc(data.as_py()):
                    head, body = _split_http(content)
                    own = _field(head, b"X-Page-Id")
                    out.append(
                        (file, offset, version, fields["url"], arc_date(fields["archive-date"]), fields["content-type"])
                        + (None if own is None else int(own), head, body if payloads else None, len(body), payload_digest(body))
                    )
                    if len(out) == 500:
                        yield _record_batch(out)
                        out = []
                if out:
                    yield _record_batch(out)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(paths)
    named = files.select(F.substring_index("path", "/", -1).alias("file"), "content")
    return named.mapInArrow(rows, RECORD)


_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
_SCHEMA = pa.schema([(n, _ARROW[k]) for n, k in (x.split() for x in RECORD.split(", "))])


def _record_batch(rows: list[tuple], schema: pa.Schema = _SCHEMA) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def with_revisits(records: DataFrame, slim: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Adds refers_arc, refers_offset, refers_page: null for the record with the smallest page_id of
    those with an equal payload (rows without page_id last, then by place), which the others revisit.

    The smallest is found from digests alone, folded before the shuffle; only digests that occur
    twice are joined back, and the optimizer may split a digest that holds many records.
    """
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "arc", "offset")
    first = (
        slim.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.min(order).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("payload_digest", "payload_bytes", "first")
    )
    joined = records.join(first, ["payload_digest", "payload_bytes"], "left")
    other = F.col("first").isNotNull() & ((F.col("first.arc") != F.col("arc")) | (F.col("first.offset") != F.col("offset")))
    for name in ("arc", "offset", "page_id"):
        joined = joined.withColumn(f"refers_{name.removesuffix('_id')}", F.when(other, F.col(f"first.{name}")))
    return joined.drop("first")


def write_warc(records: DataFrame, path: str, limit: int = ARCHIVE_BYTES) -> str:
    """Records with revisit columns as WARC 1.1 files, each with a warcinfo record at its start."""
    names = ["arc", "offset", "url", "date", "page_id", "head", "payload", "payload_digest"]
    names += ["refers_arc", "refers_offset", "refers_page"]

    def record(kind: str, ident: str, date: str, more: list[str], block: bytes) -> bytes:
        lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {ident}", f"WARC-Date: {date}", *more]
        lines.append(f"WARC-Block-Digest: sha1:{payload_digest(block)}")
        return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block

    info = b"software: accessgrid\r\nformat: WARC File Format 1.1\r\n"
    made_by = uuid.uuid5(uuid.NAMESPACE_URL, path)
    start = record("warcinfo", f"<urn:uuid:{made_by}>", arc_date(CAPTURED), ["Content-Type: application/warc-fields"], info)

    def rows(batches):
        for batch in batches:
            for arc, offset, url, date, page_id, head, payload, digest, r_arc, r_offset, r_page in zip(
                *(batch.column(i).to_pylist() for i in range(len(names)))
            ):
                more = [f"WARC-Target-URI: {url}", "Content-Type: application/http; msgtype=response"]
                more.append(f"WARC-Payload-Digest: sha1:{digest}")
                more += [] if page_id is None else [f"X-Page-Id: {page_id}"]
                if r_arc is not None:
                    more.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
                    more.append(f"WARC-Refers-To: {record_id(r_arc, r_offset)}")
                    more += [] if r_page is None else [f"X-Refers-To-Page-Id: {r_page}"]
                kind, block = ("response", head + payload) if r_arc is None else ("revisit", head)
                yield record(kind, record_id(arc, offset), date, more, block)

    slim = records.withColumn("payload", F.expr("CASE WHEN refers_arc IS NULL THEN payload END")).select(names)
    files = slim.mapInArrow(lambda b: _batches(_packed(rows(b), start, b"\r\n\r\n", limit)), "value binary")
    return _write_files(files, path, "\r\n\r\n")


def parse_warc(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(header, block) of each record, by declared lengths."""
    data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at) + 4
        head = data[at:end]
        length = int(_field(head, b"Content-Length") or 0)
        block = data[end : end + length]
        if not head.startswith(b"WARC/") or len(block) < length:
            raise ValueError(f"no whole WARC record at {at}")
        yield head, block
        at = end + length + 4


READ_BACK = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "record_id string, refers_to_id string, target_uri string, warc_date string"
)
_READ_SCHEMA = pa.schema([(n, _ARROW[k]) for n, k in (x.split() for x in READ_BACK.split(", "))])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """A row for each response and revisit; digests of responses are taken from the bytes read."""

    def rows(batches):
        for batch in batches:
            for data in batch.column(0):
                out = []
                for head, block in parse_warc(data.as_py()):
                    kind = _field(head, b"WARC-Type")
                    if kind not in ("response", "revisit"):
                        continue
                    http, body = _split_http(block)
                    said = (_field(head, b"WARC-Payload-Digest") or "").removeprefix("sha1:")
                    whole = kind == "response"
                    if whole and payload_digest(body) != said:
                        raise ValueError("a payload differs from its digest")
                    own, other = _field(head, b"X-Page-Id"), _field(head, b"X-Refers-To-Page-Id")
                    out.append(
                        (own and int(own), len(body) if whole else int(_field(http, b"Content-Length") or 0), said, kind)
                        + (other and int(other), _field(head, b"WARC-Record-ID"), _field(head, b"WARC-Refers-To"))
                        + (_field(head, b"WARC-Target-URI"), _field(head, b"WARC-Date"))
                    )
                if out:
                    yield _record_batch(out, _READ_SCHEMA)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(rows, READ_BACK)


def convert(spark: SparkSession, arc_paths: list[str], path: str, min_bytes: int = MIN_REVISIT_BYTES) -> str:
    """ARC files to WARC files."""
    records, slim = read_arc(spark, arc_paths), read_arc(spark, arc_paths, payloads=False)
    return write_warc(with_revisits(records, slim, min_bytes), path)


def pages_round_trip(pages: DataFrame) -> DataFrame:
    """Pages to legacy archives (version 1 for even page_id, else 2), those to WARC, and back.

    Null html is an empty payload, a null url `unknown:`; a page without page_id keeps none and is
    never preferred as response.  Of repeated rows one is the response.  Other columns are not read.
    An empty table gives no archives and no rows.
    """
    spark, arcs = pages.sparkSession, []
    if not pages.take(1):
        return spark.createDataFrame([], READ_BACK)
    for version in ARC_FIELDS:
        odd = F.coalesce(F.col("page_id") % 2 != 0, F.lit(True))
        arcs.append(write_arc(pages.filter(odd if version == 2 else ~odd), scratch(spark), version))
    return read_warc(spark, convert(spark, arcs, scratch(spark)))

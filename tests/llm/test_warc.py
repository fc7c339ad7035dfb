import base64
import gzip
import hashlib

import pytest

from accessgrid.llm import warc

V1 = b"filedesc://a.arc 0.0.0.0 20010203040506 text/plain 76\n1 0 Example Archive\nURL IP-address Archive-date Content-type Archive-length\n\n"


def brute(pages):
    payloads = [(i, (h or "").encode()) for i, _, h in pages]
    first = {}
    for i, p in payloads:
        if i is not None:
            first[p] = min(first.get(p, i), i)
    out, seen = [], set()
    for i, p in payloads:
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        leads = first.get(p, i) == i and (i, p) not in seen
        seen.add((i, p)) if leads else None
        out.append((i, len(p), digest, "response" if leads else "revisit", None if leads else first.get(p)))
    return sorted(out, key=str)


def rows_of(df):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)


def test_whole_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    assert rows_of(warc.pages_round_trip(pages)) == brute([tuple(r) for r in pages.collect()])


def test_odd_pages(spark, monkeypatch):
    body = "line\r\n\r\nmore\n\nHTTP/1.1 é\r\n"
    pages = [(7, "http://a b/\n", body), (3, None, body), (3, None, body), (2, "http://x", None), (9, "http://y", ""), (None, "http://z", body), (None, "u", "only"), (1, "u", "x" * 50_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "url AS head", "1 AS offset")
    assert rows_of(warc.pages_round_trip(df)) == brute(pages)
    empty = warc.pages_round_trip(df.limit(0))
    assert empty.count() == 0 and "refers_to" in empty.columns


def test_identifiers_are_unique_and_referred_to(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = warc.pages_round_trip(pages.union(pages.withColumn("page_id", pages.page_id + 1000))).collect()
    ids = {r["record_id"] for r in rows}
    assert len(ids) == len(rows)
    responses = {r["record_id"]: r["page_id"] for r in rows if r["record_type"] == "response"}
    revisits = [r for r in rows if r["record_type"] == "revisit"]
    assert revisits and all(responses[r["refers_to_id"]] == r["refers_to"] for r in revisits)


def test_version_1_headers():
    body = b"HTTP/1.0 200 OK\n\nhi"
    data = V1 + b"http://a.example/with space 1.2.3.4 20010203 text/html %d\n" % len(body) + body + b"\n"
    ((version, offset, fields, content),) = list(warc.parse_arc(data))
    assert (version, offset, content) == (1, len(V1), body)
    assert fields["url"] == "http://a.example/with space" and fields["ip-address"] == "1.2.3.4"
    assert warc.arc_date(fields["archive-date"]) == "2001-02-03T00:00:00Z"
    assert [x[3] for x in warc.parse_arc(gzip.compress(data))] == [body]


def test_version_2_headers():
    block = b"2 0 Example\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
    start = b"filedesc://b.arc 0.0.0.0 20010203040506 text/plain 200 - - 0 b.arc %d\n" % len(block) + block + b"\n"
    data = start + b"http://b/ 1.2.3.4 20010203040506 text/html 404 abc - 99 b.arc 5\nhello\n"
    ((version, _, fields, content),) = list(warc.parse_arc(data))
    assert (version, fields["result-code"], fields["checksum"], content) == (2, "404", "abc", b"hello")


def test_lengths_beyond_the_file_are_errors():
    with pytest.raises(ValueError):
        list(warc.parse_arc(V1 + b"http://a/ 1.2.3.4 20010203040506 text/html 50\nshort\n"))

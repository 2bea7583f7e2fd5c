from __future__ import annotations

import gzip
import hashlib
from collections import defaultdict

import pytest

from touchline.llm import warc

PAGES = "page_id long, url string, html string, capture string, Digest int"


def expected(rows, least=100):
    """(page_id, bytes, digest, type, refers_to, url) by plain loops."""
    groups = defaultdict(list)
    for page_id, url, html in rows:
        groups[html or ""].append((page_id is None, page_id or 0, url is None, url or "", page_id, url))
    found = []
    for html, members in groups.items():
        data = html.encode()
        members.sort()
        for k, m in enumerate(members):
            revisit = len(data) >= least and k > 0
            found.append((m[4], len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", members[0][4] if revisit else None, m[5]))
    return sorted(found, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url").collect()), key=repr)


def odd_pages():
    long = "<p>" + "ü words " * 40_000 + "</p>"
    inner = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [
        (1, "http://a.example/x?y=1#z", "same " * 30),
        (9, "http://a.example/x", "same " * 30),
        (5, "http://b.example", "same " * 30),
        (9, "http://a.example/x", "same " * 30),
        (None, None, "same " * 30),
        (2, "", None),
        (3, None, ""),
        (4, "http://c.example/\r\nHost: evil", "short"),
        (6, "http://c.example/a b%20é", "short"),
        (6, "http://c.example/a b%20é", "short"),
        (7, "u", long),
        (8, "v", long),
        (10, "w", "about WARC/1.1 and WARC/1.WARC/1.0\r\n" * 4),
        (11, "w", inner * 3 + "tail"),
        (12, "w", "x\r\n\r\n" + inner),
        (13, "w", "\r\n\r\n" * 40),
        (14, "w", "0" * 99),
        (15, "w", "0" * 99),
        (16, "w", "0" * 100),
        (17, "w", "0" * 100),
    ]
    rows += [(30, "hot", "one row " * 20)] * 2500
    rows += [(100 + i, f"u{i}", "one body " * 20) for i in range(300)]
    return rows


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_odd_pages_match_brute_force(spark, tmp_path, compression):
    rows = odd_pages()
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES)
    path = str(tmp_path / "archive")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        # Small splits, so that records of uncompressed files lie across them.
        spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
        warc.write_archive(pages, path, warc.Settings(compression=compression))
        records = warc.read_records(spark, path)
        assert records.filter("not whole").count() == 0 and records.count() == 3 * len(rows)
        captures = warc.captures(records)
        assert got(warc.described(captures)) == expected(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    one = captures.filter("target = 'u'").first()
    assert one["payload"].decode() == rows[10][2] and len(one["request"]) == 1 and len(one["metadata"]) == 1
    assert one["request"][0]["text"].startswith("GET / HTTP/1.1\r\n")


def test_every_record_is_one_of_the_format(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archive(spark.createDataFrame([(*r, "x", 1) for r in odd_pages()[:20]], PAGES), path)
    seen, ids = 0, set()
    for file in (tmp_path / "archive").glob("part-*.gz"):
        data = gzip.decompress(file.read_bytes())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines[1:])
            length = int(fields["Content-Length"])
            assert lines[0] == "WARC/1.1" and rest[length : length + 4] == b"\r\n\r\n"
            assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "WARC-Target-URI"} <= set(fields)
            ids.add(fields["WARC-Record-ID"])
            data, seen = rest[length + 4 :], seen + 1
    assert seen == 60 == len(ids)


def record(kind, name, block, *fields):
    head = [f"WARC/1.0\r\nWARC-Type: {kind}", f"WARC-Record-ID: <{name}>", *fields, f"Content-Length: {len(block)}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def test_foreign_archives(spark, tmp_path):
    http = b"HTTP/1.0 200 OK\r\n\r\n"
    members = [
        record("warcinfo", "i", b"software: x\r\n"),
        # The response names its request, and the metadata the request.
        record("response", "r1", http + b"\xff\xfe binary \x00", "warc-concurrent-to: <q1>", "WARC-Target-URI: http://x/"),
        record("request", "q1", b"GET / HTTP/1.0\r\n\r\n"),
        record("metadata", "m1", b"page_id: 77\r\n", "WARC-Concurrent-To: <q1>"),
        record("revisit", "r2", b"HTTP/1.0 200 OK\r\nContent-Length: 9\r\n\r\n", "WARC-Refers-To: <r1>", "WARC-Payload-Digest: sha256:ab"),
        record("revisit", "r3", b"HTTP/1.0 200 OK\r\nContent-Length: 9\r\n\r\n", "WARC-Refers-To: <none>", "WARC-Payload-Digest: sha256:ab"),
        record("response", "cut", http + b"longer than it is", "X: y")[:-20],
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(m) for m in members))
    records = warc.read_records(spark, str(tmp_path / "a.warc.gz"))
    assert {(r["record_id"], r["kind"], r["whole"]) for r in records.collect()} == {
        ("<i>", "warcinfo", True), ("<r1>", "response", True), ("<q1>", "request", True), ("<m1>", "metadata", True),
        ("<r2>", "revisit", True), ("<r3>", "revisit", True), ("<cut>", "response", False),
    }
    found = {r["record_id"]: r for r in warc.captures(records).collect()}
    assert set(found) == {"<r1>", "<r2>", "<r3>"}
    assert bytes(found["<r1>"]["payload"]) == b"\xff\xfe binary \x00"
    assert [r["record_id"] for r in found["<r1>"]["request"]] == ["<q1>"] and [r["record_id"] for r in found["<r1>"]["metadata"]] == ["<m1>"]
    digest = hashlib.sha256(b"\xff\xfe binary \x00").hexdigest()
    assert sorted((tuple(r)[1:5] for r in warc.described(warc.captures(records)).collect()), key=repr) == sorted(
        [(11, digest, "response", None), (11, digest, "revisit", 77), (9, "ab", "revisit", None)], key=repr
    )


def test_no_pages(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archive(spark.createDataFrame([], PAGES), path)
    assert got(warc.described(warc.captures(warc.read_records(spark, path)))) == []

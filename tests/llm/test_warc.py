import base64
import gzip
import hashlib
import json

import pytest

from mattercat.llm import warc

PAGE = "<html><title>t</title><body><a href='/x'>Link</a><p>Some &amp; text</p><img src=\"i.png\"></body></html>"
HTTP = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-A: b\r\n\r\n" + PAGE).encode()


def rows_of(spark, *blocks):
    data = [(f"<urn:uuid:{i}>", f"http://h/{i}", "2024-01-01T00:00:00Z", b, "k") for i, b in enumerate(blocks)]
    frame = spark.createDataFrame(data, "record_id string, target_uri string, date string, block binary, record_type string")
    return warc.derive(frame)


def test_records_are_linked_and_keep_headers_and_digests(spark):
    got = {r.record_type: r for r in rows_of(spark, HTTP).collect()}
    sha = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
    for r in got.values():
        assert (r.refers_to, r.target_uri, r.date) == ("<urn:uuid:0>", "http://h/0", "2024-01-01T00:00:00Z")
        assert r.block_digest == sha(r.block.encode()) and r.content_length == len(r.block.encode())
        assert r.source_block_digest == sha(HTTP) and r.source_payload_digest == sha(PAGE.encode())
    assert got["conversion"].block == "Link\nSome & text" and got["conversion"].record_id != got["metadata"].record_id
    head = json.loads(got["metadata"].block)["Envelope"]
    http = head["Payload-Metadata"]["HTTP-Response-Metadata"]
    assert http["Status-Line"] == "HTTP/1.1 200 OK" and ["X-A", "b"] in http["Headers"]
    assert [(x["path"], x["url"]) for x in http["HTML-Metadata"]["Links"]] == [("A@/href", "/x"), ("IMG@/src", "i.png")]


def test_edge_cases(spark):
    other = b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n\x89PNG"
    latin = "HTTP/1.1 200 OK\r\nContent-Type: text/plain; charset=latin-1\r\n\r\né".encode("latin-1")
    odd = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=no-such\r\n\r\n<p>x"
    got = [r.block for r in rows_of(spark, None, b"", other, latin, odd, b"no head").collect() if r.record_type == "conversion"]
    assert got == ["", "", "", "é", "x", "no head"]
    frame = spark.createDataFrame([(None, None, None, HTTP)] * 2, warc.RESPONSE)
    assert len(warc.derive(frame).collect()) == 4 and warc.derive(frame.limit(0)).collect() == []


def test_archive_round_trip(spark, tmp_path):
    derived = rows_of(spark, HTTP, b"")
    members = [bytes(r.member) for r in warc.archive_members(derived).collect()]
    records = list(warc.parse_records(b"".join(members)))
    want = derived.collect()
    assert [b.decode() for _, b in records] == [r.block for r in want]
    assert [f["warc-refers-to"] for f, _ in records] == [r.refers_to for r in want]
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:9>\r\nContent-Length: {len(HTTP)}\r\n\r\n".encode()
    (tmp_path / "a.warc").write_bytes((head + HTTP + b"\r\n\r\n") * 2 + b"".join(warc.record_bytes(r.asDict()) for r in want))
    read = warc.read_responses(spark, str(tmp_path)).collect()
    assert [(r.record_id, bytes(r.block)) for r in read] == [("<urn:uuid:9>", HTTP)] * 2


def test_damaged_archives_are_reported_or_read_around():
    record = lambda i: f"WARC/1.0\r\nWARC-Record-ID: {i}\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n".encode()
    bad = [b"stray line\r\n", b"WARC/1.0\r\nContent-Length: x\r\n\r\nabc\r\n\r\n", b"WARC/1.0 no end\r\n"]
    for junk in bad:
        damage = []
        found = list(warc.parse_records(record(1) + junk + record(2) + record(3), damage))
        assert [f["warc-record-id"] for f, _ in found][-2:] == ["2", "3"] and found[0][0]["warc-record-id"] == "1" and sum(damage) == len(junk)
        with pytest.raises(ValueError):
            list(warc.parse_records(record(1) + junk + record(2)))
    cut = record(1) + record(2)[:-6]
    assert [f["warc-record-id"] for f, _ in warc.parse_records(cut, [])] == ["1"]
    zipped = [gzip.compress(record(i)) for i in range(4)]
    broken = zipped[1][:12] + b"\0" * 9 + zipped[1][21:]
    damage = []
    assert [f["warc-record-id"] for f, _ in warc.parse_records(zipped[0] + broken + zipped[2] + zipped[3][:-9], damage)] == ["0", "2"]
    assert sum(damage) == len(broken) + len(zipped[3]) - 9
    assert list(warc.parse_records(b"")) == [] and len(list(warc.parse_records(gzip.compress(record(1) + record(2))))) == 2


def test_responses_from_pages(spark):
    pages = spark.createDataFrame([(1, "http://u", "<p>é</p>"), (None, None, None)], "page_id bigint, url string, html string")
    rows = warc.responses_from_pages(pages, "2024-01-01T00:00:00Z").collect()
    assert warc.split_http(bytes(rows[0].block))[2] == "<p>é</p>".encode() and b"Content-Length: 9\r\n" in bytes(rows[0].block)
    assert warc.split_http(bytes(rows[1].block))[2] == b"" and rows[0].record_id != rows[1].record_id

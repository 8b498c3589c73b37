import base64
import gzip
import hashlib
import io

import pytest

from corploom.llm.frames import read_file, write_file
from corploom.llm.queries import op6_warc
from corploom.llm.warc import captures, read_captures, read_records, records, write_warc
from corploom.session import scratch_path
from tests.conftest import DATA
from tests.llm.cases import given

PAGES = [
    (1, "http://a.example/x y\r\nz", "<p>one</p>"),
    (2, "https://[bad/", "<p>one</p>"),
    (3, None, None),
    (4, "http://b.example/", ""),
    (5, "http://b.example/é?q=1", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 3),
    (6, "http://c.example", "x" * 3_000_000),
    (7, "http://c.example", "x" * 3_000_000),
    (7, "http://c.example", "x" * 3_000_000),
    (None, "http://d.example", "<p>one</p>"),
    (None, "http://d.example", "alone"),
    (8, "http://e.example", "漢字 \x00 ퟿"),
]


def by_hand(pages, least=0):
    largest = {}
    for page, _, text in pages:
        if page is not None and len((text or "").encode()) >= least:
            largest[text or ""] = max(page, largest.get(text or "", page))
    out = []
    for page, _, text in pages:
        body = (text or "").encode()
        keeper = largest.get(text or "")
        again = keeper is not None and page != keeper
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page, len(body), digest, "revisit" if again else "response", keeper if again else None))
    return sorted(out, key=str)


def test_given_pages(spark):
    got = op6_warc(spark, DATA).collect()
    assert sorted(map(tuple, got), key=str) == by_hand(given("pages", "page_id, url, html"))


@pytest.mark.parametrize("least", (0, 11))
def test_edge_rows(spark, least):
    frame = spark.createDataFrame(
        [(*p, "x", "y") for p in PAGES], "page_id bigint, url string, html string, type string, payload string"
    )
    root = scratch_path(spark, "warc")
    write_warc(frame, root, min_revisit_bytes=least)
    got = read_captures(spark, root).collect()
    digest = [(r.page_id, r.payload_bytes, r.payload_digest, r.type, r.refers_to) for r in got]
    assert sorted(digest, key=str) == by_hand(PAGES, least)
    bodies = {p: (t or "").encode() for p, _, t in PAGES}
    for r in got:
        assert len(r.requests) == 1 and len(r.metadata) == 1
        assert r.requests[0].target_uri == r.target_uri
        if r.type == "response" and r.page_id is not None:
            assert bytes(r.payload) == bodies[r.page_id]
        if r.type == "revisit":
            assert r.payload is None and r.refers_to_uri
    assert {r.target_uri for r in got if r.page_id == 1} == {"http://a.example/x%20y%0D%0Az"}


def test_empty_table(spark):
    root = scratch_path(spark, "warc")
    write_warc(spark.createDataFrame([], "page_id bigint, url string, html string"), root)
    assert read_captures(spark, root).collect() == []


def test_a_capture_is_three_members(spark):
    root = scratch_path(spark, "warc")
    write_warc(spark.createDataFrame([(1, "http://a.example/p", "hi")], "page_id bigint, url string, html string"), root)
    (file,) = spark.read.parquet(f"{root}/archives").collect()
    data = read_file(root, file.file)
    found = list(records(io.BytesIO(gzip.decompress(data))))
    assert [h["warc-type"] for h, _ in found] == ["warcinfo", "request", "response", "metadata"]
    assert found[1][0]["warc-concurrent-to"] == found[2][0]["warc-record-id"] == found[3][0]["warc-concurrent-to"]
    assert found[2][1].endswith(b"\r\n\r\nhi") and data.count(b"\x1f\x8b\x08") >= 4


def foreign(digest):
    body = b"HTTP/1.0 404 Not Found\r\nX-A: 1\r\n folded\r\n\r\nbody"
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:a>\r\nwarc-payload-digest: sha1:{digest}\r\n"
    head += f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(body)}\r\n\r\n"
    return gzip.compress(head.encode() + body + b"\r\n\r\n")


def test_archives_of_others(spark):
    root = scratch_path(spark, "warc")
    write_file(root, "a.warc.gz", foreign(base64.b32encode(hashlib.sha1(b"body").digest()).decode()))
    spark.createDataFrame([("a.warc.gz",)], "file string").write.parquet(f"{root}/archives")
    (row,) = captures(read_records(spark, root)).collect()
    assert bytes(row.payload) == b"body" and row.fields["x-a"] == "1 folded" and row.requests is None


def test_damage_is_told(spark):
    root = scratch_path(spark, "warc")
    write_file(root, "a.warc.gz", foreign("A" * 32))
    spark.createDataFrame([("a.warc.gz",)], "file string").write.parquet(f"{root}/archives")
    with pytest.raises(Exception, match="does not match its digest"):
        read_records(spark, root).collect()

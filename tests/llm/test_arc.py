"""ARC to WARC: parsing by version and declared length, and whole round trips."""
import base64
import gzip
import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from hostlake.llm import arc


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def slow(pages):
    last = {}
    for i, _, h in pages:
        if i is not None:
            last[h or ""] = max(i, last.get(h or "", i))
    return last


ODD = [(1, "http://a.org/x y", "<p>é</p>"), (2, None, None), (3, "", ""), (4, "http://a.org/", "<p>é</p>"),
       (5, "dns:a.org", "WARC/1.1\r\nContent-Length: 5\r\n\r\n\r\n\r\nHTTP/1.1 200 OK\r\n\r\nfiledesc://x 1\n"),
       (6, "http://b/\n\t\x7f", "\r\n\r\n\n\nx" * 9), (-7, "http://c/", "neg"), (None, "http://n/", "none"), (None, "http://n2/", "none"),
       (8, "http://long/", "lorem " * 400_000), (9, "x" * 5000, "\x00﻿ end\r\n")]


def test_odd_pages(spark, scratch):
    df = spark.createDataFrame(ODD, "page_id long, url string, html string").withColumns({"record_id": F.lit(1), "path": F.lit(2)})
    out = arc.archive_pages(df).collect()
    assert len(out) == len(ODD)
    last = slow(ODD)
    for i, _, h in ODD:
        if i is not None:
            (r,) = [r for r in out if r.page_id == i]
            assert r.payload_bytes == len((h or "").encode()) and r.payload_digest == sha(h)
            first = last[h or ""] == i
            assert r.record_type == ("response" if first else "revisit") and r.refers_to == (None if first else last[h or ""])
    both = sorted((r.record_type, r.refers_to, r.payload_bytes) for r in out if r.page_id is None)
    assert both == [("response", None, 4), ("revisit", None, 4)]


def test_both_versions_are_written(spark, scratch):
    df = spark.range(40).selectExpr("id AS page_id", "'http://h/' AS url", "repeat('x', 300) AS html").repartition(3)
    path = scratch("arc")
    arc.write_arc(df, path, archive_bytes=2_000)
    heads = [gzip.decompress(bytes(r.content)).split(b"\n")[1][:1] for r in arc._archives(spark, path).collect()]
    assert set(heads) == {b"1", b"2"} and abs(heads.count(b"1") - heads.count(b"2")) <= 3


def test_min_bytes_and_repeated_rows(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (3, "u", "abcd"), (4, "u", "abcd")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = sorted((r.page_id, r.record_type, r.refers_to) for r in arc.archive_pages(df, min_bytes=3).collect())
    assert out == [(1, "response", None), (2, "response", None), (3, "revisit", 4), (3, "revisit", 4), (4, "response", None)]
    assert arc.archive_pages(df.limit(0)).collect() == []


def test_files_are_whole_archives(spark, scratch, tmp_path):
    df = spark.createDataFrame([(i, f"http://h/{i}", "x" * 300) for i in range(50)], "page_id long, url string, html string")
    path = scratch("arc")
    for v in (1, 2):
        arc.write_arc(df.coalesce(1), f"{path}/arc/v{v}", v, archive_bytes=5_000)
    arc.convert(spark, f"{path}/arc", f"{path}/warc")
    arcs = [gzip.decompress(bytes(r.content)) for r in arc._archives(spark, f"{path}/arc").collect()]
    assert len(arcs) > 8 and all(a.startswith(b"filedesc://") for a in arcs)
    assert sum(len(list(arc.parse_arc(a))) for a in arcs) == 100 + len(arcs)
    warcs = [gzip.decompress(bytes(r.content)) for r in arc._archives(spark, f"{path}/warc").collect()]
    records = [x for w in warcs for x in arc.parse_warc(w)]
    assert len(warcs) == len(arcs) and [f["WARC-Type"] for f, _ in records].count("warcinfo") == len(arcs)
    assert len({f["WARC-Record-ID"] for f, _ in records}) == len(records)
    for f, block in records:
        uuid.UUID(f["WARC-Record-ID"][len("<urn:uuid:"):-1])
        assert f["WARC-Date"].startswith("2024-01-01T00:00:") and f["WARC-Block-Digest"] == "sha1:" + arc.base32_sha1(block)
    kinds = [f["WARC-Type"] for f, _ in records]
    assert kinds.count("response") == 1 and kinds.count("revisit") == 99
    (full,) = [f for f, _ in records if f["WARC-Type"] == "response"]
    assert {f["WARC-Refers-To"] for f, _ in records if f["WARC-Type"] == "revisit"} == {full["WARC-Record-ID"]}


def head(version, fields):
    block = f"{version} 0 x\n{fields}\n".encode()
    return b"filedesc://f.arc 0.0.0.0 20010101000000 text/plain %d\n" % len(block) + block + b"\n"


def test_versions_and_lengths():
    one = head(1, arc.FIELDS[1]) + b"http://a/b c 1.2.3.4 20010203040506 text/html 7\nab\ncd\n\n\n\nnews:x 1.1.1.1 20010203040507 text/plain 0\n\n"
    got = list(arc.parse_arc(one))
    assert [(r["url"], r["block"]) for r in got[1:]] == [("http://a/b c", b"ab\ncd\n\n"), ("news:x", b"")]
    two = head(2, arc.FIELDS[2]) + b"http://a/ 1.2.3.4 20010203040506 text/html 200 abc - 77 f.arc 3\nxyz\n"
    assert [(r["url"], r["mime"], r["date"], r["block"]) for r in arc.parse_arc(two)][1:] == [
        ("http://a/", "text/html", "20010203040506", b"xyz")]
    assert list(arc.parse_arc(b"")) == []


def test_broken_archives_are_errors():
    with pytest.raises(ValueError, match="declares"):
        list(arc.parse_arc(head(1, arc.FIELDS[1]) + b"http://a/ 1.2.3.4 20010203040506 text/html 70\nab\n"))
    with pytest.raises(ValueError, match="filedesc"):
        list(arc.parse_arc(b"http://a/ 1.2.3.4 20010203040506 text/html 2\nab\n"))


def test_records_without_http_become_resources():
    r = {"offset": 9, "url": "ftp://a/x", "ip": "1.2.3.4", "date": "20010203040506", "mime": "text/plain", "block": b"abc"}
    ((fields, block),) = arc.parse_warc(arc.convert_record("f.arc.gz", r, None) + arc.WARC_END)
    assert block == b"abc" and fields["WARC-Type"] == "resource" and fields["Content-Type"] == "text/plain"
    assert fields["WARC-Date"] == "2001-02-03T04:05:06Z" and fields["WARC-Payload-Digest"] == "sha1:" + arc.base32_sha1(b"abc")

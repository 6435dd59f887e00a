"""Legacy ARC archives converted to WARC.

``write_arc`` writes pages as ARC files (version 1 or 2). ``convert`` parses them by each version's header line and the
declared record lengths, and writes equivalent WARC files: record ids, timestamps, types, block and payload digests are
synthesised from what the ARC records hold. Of records with equal payloads one is the response, the others are revisit
records that refer to it. ``read_warc`` reads the WARC files back.

One archive is one row and one file (a few MB, gzipped as a whole by Spark's text writer), so memory is bounded by
``archive_bytes`` and the longest record. Payloads are not shuffled: digests and positions are, and each archive meets
the list of its own records' decisions.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostlake.llm.common import cut, small_batches
from hostlake.session import scratch_dir

ARCHIVE_BYTES = 8 << 20
#: The fields of a URL record by ARC version, the URI of revisits by payload, the end of a WARC record.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_END = b"\r\n\r\n"
EPOCH = datetime(2024, 1, 1, tzinfo=UTC)
_GZIP = {"compression": "gzip", "maxRecordsPerFile": "1", "zlib.compress.level": "BEST_SPEED"}


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---- ARC ----------------------------------------------------------------------------------------------------------

def _escaped(url: str | None) -> str:
    """A url without the characters that end an ARC field; '-' for none."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "-"


def _http(page_id, payload: bytes) -> bytes:
    own = b"" if page_id is None else b"X-Page-Id: %d\r\n" % page_id
    return (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + own
            + b"Content-Length: %d\r\n\r\n" % len(payload) + payload)


def _arc_head(name: str, version: int, stamp: str) -> bytes:
    block = f"{version} 0 hostlake\n{FIELDS[version]}\n".encode()
    line = {1: f"filedesc://{name} 0.0.0.0 {stamp} text/plain {len(block)}\n",
            2: f"filedesc://{name} 0.0.0.0 {stamp} text/plain 200 - - 0 {name} {len(block)}\n"}[version]
    return line.encode() + block + b"\n"


def write_arc(pages: DataFrame, path: str, version: int | None = None, archive_bytes: int = ARCHIVE_BYTES,
              id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """ARC files of HTTP responses with the html as payload (null: empty), about ``archive_bytes`` each before gzip.

    The page id is a header field of the response, absent where null. The capture time is a second of the year from
    the id. Spaces and control characters in urls are percent-encoded, a null or empty url is '-'. Without ``version``
    each task's archives have versions 1 and 2 in turn, from 1 or 2 by the task's number.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, name = [], 0, ""
        now = version or 1 + TaskContext.get().partitionId() % 2

        def archive():
            return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)[:-1]], pa.binary())], names=["value"])

        for batch in batches:
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                stamp = (EPOCH + timedelta(seconds=(page_id or 0) % 31_536_000)).strftime("%Y%m%d%H%M%S")
                if not parts:
                    name = f"{uuid.uuid4().hex}.arc"
                    parts.append(_arc_head(name, now, stamp))
                    size = len(parts[0])
                block = _http(page_id, (html or "").encode())
                line = {1: f"{_escaped(url)} 127.0.0.1 {stamp} text/html {len(block)}\n",
                        2: f"{_escaped(url)} 127.0.0.1 {stamp} text/html 200 {base32_sha1(block)} - {size} {name} {len(block)}\n"}
                parts += [line[now].encode(), block, b"\n"]
                size += sum(map(len, parts[-3:]))
                if size >= archive_bytes:
                    yield archive()
                    parts, now = [], version or 3 - now
        if parts:
            yield archive()

    small_batches(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("long"), url_col, html_col).mapInArrow(run, "value binary")
    rows.select(F.col("value").cast("string")).write.options(**_GZIP, lineSep="\n").mode("append").text(path)


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records of one ARC file: offset, url, ip, date, mime, block.

    The first record's block says which version's header lines follow; fields are counted from the line's end, so a
    url with spaces is read whole. Blocks are taken by their declared lengths, never searched for.
    """
    at, fields = 0, None
    while True:
        while data[at:at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            return
        end = data.index(b"\n", at)
        line = data[at:end].decode("utf-8", "surrogateescape").rstrip("\r")
        length = int(line.rsplit(" ", 1)[1])
        block = data[end + 1:end + 1 + length]
        if len(block) < length:
            raise ValueError(f"record at {at} declares {length} bytes; {len(block)} are left")
        if fields is None:
            if not line.startswith("filedesc:"):
                raise ValueError("an ARC file starts with a filedesc record")
            fields = len(FIELDS[int(block.split(b" ", 1)[0])].split())
        values = line.rsplit(" ", fields - 1)
        yield {"offset": at, "url": values[0], "ip": values[1], "date": values[2], "mime": values[3], "block": block}
        at = end + 1 + length


def payload_of(block: bytes) -> tuple[bytes, bytes]:
    """(HTTP head with its blank line, payload); a block that is no HTTP response is all payload."""
    if block.startswith(b"HTTP/") and (cut_at := block.find(b"\r\n\r\n")) >= 0:
        return block[:cut_at + 4], block[cut_at + 4:]
    return b"", block


def page_id_of(head: bytes) -> int | None:
    found = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", head)
    return int(found[1]) if found else None


# ---- conversion ---------------------------------------------------------------------------------------------------

def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")


def _positions(arcs: DataFrame) -> DataFrame:
    """(path, offset, page_id, digest, bytes) of all HTTP records."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for r in parse_arc(gzip.decompress(content.as_py())):
                    head, payload = payload_of(r["block"])
                    if head:
                        rows.append((path, r["offset"], page_id_of(head), base32_sha1(payload), len(payload)))
                cols = list(zip(*rows, strict=True)) or [[]] * 5
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                                 names=["path", "offset", "page_id", "digest", "bytes"])

    return arcs.mapInArrow(run, "path string, offset long, page_id long, digest string, bytes long")


def record_id(path: str, offset: int) -> str:
    """A WARC record id that depends on the ARC file's name and the record's place only."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{path.rsplit("/", 1)[-1]}#{offset}')}>"


def _warc(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "surrogateescape") + b"\r\n" + block


def convert_record(path: str, r: dict, refers: dict | None) -> bytes:
    """The WARC record of an ARC record; ``refers`` (path, offset) makes it a revisit of that response."""
    head, payload = payload_of(r["block"])
    date = datetime.strptime(r["date"][:14], "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    if r["url"].startswith("filedesc:"):
        kind, mime, block = "warcinfo", "application/warc-fields", b"software: hostlake\r\nformat: WARC File Format 1.1\r\n"
    elif not head:
        kind, mime, block = "resource", r["mime"], r["block"]
    else:
        kind, mime = ("revisit" if refers else "response"), "application/http; msgtype=response"
        block = head if refers else r["block"]
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id(path, r["offset"])), ("WARC-Date", date)]
    if kind != "warcinfo":
        if r["url"] != "-":
            fields.append(("WARC-Target-URI", r["url"]))
        fields += [("WARC-IP-Address", r["ip"]), ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}")]
    if refers:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers["path"], refers["offset"]))]
    fields += [("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Type", mime)]
    return _warc(fields, block)


def decide(positions: DataFrame, min_bytes: int) -> DataFrame:
    """(path, revisits array<struct<offset, refers<path, offset>>>): the revisits of each archive.

    Among equal payloads of at least ``min_bytes`` the record with the largest page id is the response (null ids are
    the smallest; ties: the last archive and offset). One row per payload is aggregated before the shuffle; a payload
    in a third of all records meets that one row.
    """
    chosen = positions.where(F.col("bytes") >= min_bytes)
    last = chosen.groupBy("digest", "bytes").agg(
        F.max(F.struct("page_id", "path", "offset")).alias("r"), F.count("*").alias("n")).where("n > 1")
    revisits = chosen.join(last, ["digest", "bytes"]).where("path != r.path OR offset != r.offset")
    return revisits.groupBy("path").agg(F.collect_list(F.struct(
        "offset", F.struct(F.col("r.path").alias("path"), F.col("r.offset").alias("offset")).alias("refers"))).alias("revisits"))


def convert(spark: SparkSession, arc_path: str, warc_path: str, min_bytes: int = 0) -> None:
    """Writes a WARC file for each ARC file below ``arc_path``."""
    small_batches(spark)
    arcs = _archives(spark, arc_path)
    revisits = decide(cut(_positions(arcs)), min_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                refers = {x["offset"]: x["refers"] for x in found or []}
                records = [convert_record(path, r, refers.get(r["offset"])) for r in parse_arc(gzip.decompress(content.as_py()))]
                if records:  # Spark writes one empty file for a table without rows
                    yield pa.RecordBatch.from_arrays([pa.array([WARC_END.join(records)], pa.binary())], names=["value"])

    rows = arcs.join(revisits, "path", "left").select("path", "content", "revisits").mapInArrow(run, "value binary")
    rows.select(F.col("value").cast("string")).write.options(**_GZIP, lineSep=WARC_END.decode()).text(warc_path)


# ---- WARC ---------------------------------------------------------------------------------------------------------

def parse_warc(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """(named fields, block) of each record of a WARC file, by declared lengths."""
    at = 0
    while at < len(data):
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at {at}")
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "surrogateescape").split("\r\n")[1:]
        fields = dict(x.split(": ", 1) for x in lines)
        length = int(fields["Content-Length"])
        block = data[end + 4:end + 4 + length]
        if len(block) < length:
            raise ValueError(f"record at {at} declares {length} bytes; {len(block)} are left")
        yield fields, block
        at = end + 4 + length + len(WARC_END)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, record_id, refers_to_id, target_uri, date) of all response
    and revisit records; payload_bytes is null for revisits, which hold no payload."""
    kinds = [("page_id", pa.int64()), ("payload_bytes", pa.int64())] + [(c, pa.string()) for c in (
        "payload_digest", "record_type", "record_id", "refers_to_id", "target_uri", "date")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for f, block in parse_warc(gzip.decompress(content.as_py())):
                    if f["WARC-Type"] in ("response", "revisit"):
                        head, payload = payload_of(block)
                        digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
                        full = f["WARC-Type"] == "response"
                        if full and digest != base32_sha1(payload):
                            raise ValueError(f"{f['WARC-Record-ID']}: the payload doesn't have its digest")
                        rows.append((page_id_of(head), len(payload) if full else None, digest, f["WARC-Type"],
                                     f["WARC-Record-ID"], f.get("WARC-Refers-To"), f.get("WARC-Target-URI"), f["WARC-Date"]))
                cols = list(zip(*rows, strict=True)) or [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(cols, kinds, strict=True)],
                                                 names=[n for n, _ in kinds])

    small_batches(spark)
    schema = "page_id long, payload_bytes long, " + ", ".join(f"{n} string" for n, _ in kinds[2:])
    return _archives(spark, path).select("content").mapInArrow(run, schema)


def archive_pages(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", path: str | None = None) -> DataFrame:
    """Pages through ARC and WARC archives and back: (id, payload_bytes, payload_digest, record_type, refers_to).

    Archives have versions 1 and 2 in turn; pages are read once. One row per page: the payload is the
    html in UTF-8 (null: empty); of records with equal payloads of at least ``min_bytes`` that with the largest id is
    the response and the others revisit it (``refers_to`` its id); where all ids are null, refers_to is null. Ids are
    integers; other columns are not read. An empty table gives no archive and no rows. The archives stay in ``path``
    (default: a new folder in the shared checkpoint folder).
    """
    spark = pages.sparkSession
    path = path or scratch_dir(spark, "archives")
    write_arc(pages, f"{path}/arc", id_col=id_col, url_col=url_col, html_col=html_col)
    convert(spark, f"{path}/arc", f"{path}/warc", min_bytes)
    records = read_warc(spark, f"{path}/warc")
    records = cut(records.select("page_id", "payload_bytes", "payload_digest", "record_type", "record_id", "refers_to_id"))
    named = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("full"))
    referred = records.where("record_type = 'revisit'").join(named, "refers_to_id").select(
        "page_id", F.col("full").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    plain = records.where("record_type = 'response'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    return plain.union(referred).withColumnRenamed("page_id", id_col)

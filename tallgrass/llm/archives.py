"""Web archives: writing legacy ARC files, converting them to WARC records with revisits, reading WARC files back."""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, scratch, stored
from .textops import pieces

# The field names that the second and third lines of a version block announce, by version.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SMALLEST_REVISITED = 100

_RECORD = "page_id long, url string, date string, ip string, mime string, locator string, http binary, payload binary, payload_bytes long, payload_digest string, problem string"
_WARC = "record_type string, record_id string, refers_to_id string, page_id long, url string, date string, payload_bytes long, payload_digest string, block_bytes long"


def _version_block(version: int) -> str:
    body = f"{version} 0 tallgrass\n{' '.join(ARC_FIELDS[version])}\n"
    fields = {"URL": "filedesc://pages.arc", "IP-address": "0.0.0.0", "Archive-date": "20240101000000", "Content-type": "text/plain", "Archive-length": str(len(body))}
    return " ".join(fields.get(f, "-") for f in ARC_FIELDS[version]) + "\n" + body


def _escaped(url: str) -> str:
    return re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url) or "-"


def _arc_record(version: int, page: int | None, url: str, payload: bytes) -> bytes:
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (f"X-Page-Id: {page}\r\n" if page is not None else "") + "\r\n"
    fields = {"URL": _escaped(url), "IP-address": "192.0.2.1", "Archive-date": "20240101000000", "Content-type": "text/html", "Result-code": "200", "Archive-length": str(len(http) + len(payload))}
    return (" ".join(fields.get(f, "-") for f in ARC_FIELDS[version]) + "\n" + http).encode() + payload


def _arc_file(version: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The version block and records of one file; without a version, the first page id decides between 1 and 2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = None
        for batch in pieces(batches, "_html"):
            out = []
            if chosen is None:
                chosen = version or 1 + (batch["_id"][0].as_py() or 0) % 2
                out.append(_version_block(chosen).encode())
            rows = zip(batch["_id"].to_pylist(), batch["_url"].to_pylist(), batch["_html"].to_pylist(), strict=True)
            out += [_arc_record(chosen, *row) for row in rows]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    return run


def _write_bytes(rows: DataFrame, path: str, end: str) -> None:
    """Write binary values to gzip files of Spark's text sink, which writes the bytes of a string as they are."""
    rows.select(F.col("value").cast("string")).write.option("compression", "gzip").option("lineSep", end).text(path)


def write_arc(pages: DataFrame, path: str, *, page_id: str = "page_id", url: str = "url", html: str = "html", version: int | None = None) -> None:
    """Write every page as a record of an ARC file; a partition is a file, of format 1 or 2 by its first page id.

    ``html`` is text or binary. The record's block is an HTTP response whose header names the page id. Files are
    written by Spark's text sink, so any store that Spark can write will do.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("_id"), F.coalesce(F.col(url), F.lit("")).alias("_url"), F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("_html"))
    _write_bytes(rows.mapInArrow(_arc_file(version), "value binary"), path, "\n")


def _stream(content: bytes) -> io.BufferedReader:
    return io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content), 1 << 20)


def arc_records(stream: io.BufferedReader) -> Iterator[tuple[dict[str, str], bytes, int, str | None]]:
    """Header fields, block and offset of every record after the version block, by declared lengths, and what is wrong.

    A record that ends before its declared length is ``cut``. A line that is no header, for want of fields or of a
    length, is ``no header`` with the line as its URL; what follows is passed over up to the next header.
    """
    names: list[str] = []
    at, lost = 0, False
    while line := stream.readline():
        start, at = at, at + len(line)
        words = line.decode("utf-8", "replace").rstrip("\r\n").split(" ")
        if words == [""]:
            continue
        if not words[-1].isdecimal() or len(words) < len(names):
            if not lost:
                yield {"URL": " ".join(words)}, b"", start, "no header"
            lost = True
            continue
        block = stream.read(int(words[-1]))
        at += len(block)
        lost = False
        if not names:
            lines = block.decode("utf-8", "replace").split("\n")
            version = lines[0].split(" ")[0]
            names = lines[1].split(" ") if len(lines) > 1 and lines[1] else ARC_FIELDS[2 if version == "2" else 1]
            continue
        # a URL may hold spaces; the other fields can't
        spare = len(words) - len(names)
        fields = dict(zip(names, [" ".join(words[: spare + 1]), *words[spare + 1 :]], strict=True))
        yield fields, block, start, "cut" if len(block) < int(words[-1]) else None


def _http(block: bytes) -> tuple[bytes, bytes]:
    head, gap, payload = block.partition(b"\r\n\r\n")
    return (head + gap, payload) if gap and head.startswith(b"HTTP/") else (b"", block)


def _page_id(http: bytes) -> int | None:
    found = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", http)
    return int(found[1]) if found else None


def _batches(rows: Iterator[tuple], schema: pa.Schema, weigh: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weigh(row)
        if size > 1 << 22 or len(held) >= 5000:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in ddl.split(", "))])


def _parse_arc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"].to_pylist(), strict=True):
                for f, block, at, problem in arc_records(_stream(content)):
                    http, payload = _http(block)
                    told = [f.get(k) for k in ("URL", "Archive-date", "IP-address", "Content-type")]
                    yield _page_id(http), *told, f"{path.rpartition('/')[2]}:{at:012d}", http, payload, len(payload), hashlib.sha256(payload).hexdigest(), problem

    return _batches(rows(), _arrow(_RECORD), lambda r: len(r[7]))


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """Parse ARC files of either version: a row per record, with the payload's bytes, their number and SHA-256.

    Records that can't be read whole are rows too, with a ``problem``; see ``arc_records``. A block that is no HTTP
    response, such as a DNS record, is all payload.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_parse_arc, _RECORD)


def plan_revisits(records: DataFrame, smallest: int = SMALLEST_REVISITED) -> DataFrame:
    """The records without a problem, with ``first``, the locator of the record that a record repeats, or null.

    Of records with equal payloads of at least ``smallest`` bytes, the first by (page_id with null last, url, locator)
    stays a response. Digests are grouped with partial sums; copies in thousands cost one row a task.
    """
    records = records.filter("problem IS NULL")
    rank = F.struct(F.col("page_id").isNull().alias("n"), F.col("page_id").alias("p"), F.col("url").alias("u"), F.col("locator").alias("l"))
    large = F.col("payload_bytes") >= smallest
    first = records.filter(large).groupBy(F.col("payload_digest").alias("_d")).agg(F.min(rank).alias("_f"), F.count("*").alias("_n")).filter("_n > 1")
    first = stored(first, "first-records")  # once written its size is known, and copies in one group are split or met by a broadcast
    joined = records.join(first, large & (F.col("payload_digest") == F.col("_d")), "left")
    return joined.withColumn("first", F.when(F.col("_f.l") != F.col("locator"), F.col("_f.l"))).drop("_d", "_f", "_n")


def _uuid(locator: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, locator)}>"


def _warc_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "payload"):
        out = []
        for r in batch.to_pylist():
            block = r["http"] if r["first"] is not None else r["http"] + r["payload"]
            d = (re.sub(r"\D", "", r["date"] or "") or "1970").ljust(14, "0")
            d = d[:4] + max(d[4:6], "01") + max(d[6:8], "01") + d[8:]
            head = {
                "WARC-Type": "response" if r["first"] is None else "revisit",
                "WARC-Record-ID": _uuid(r["locator"]),
                "WARC-Date": f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z",
                "WARC-Target-URI": _escaped(r["url"]),
                "WARC-IP-Address": r["ip"] or "0.0.0.0",
                "WARC-Payload-Digest": f"sha256:{r['payload_digest']}",
                "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
                "X-Payload-Length": str(r["payload_bytes"]),
            }
            if r["first"] is not None:
                head |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": _uuid(r["first"])}
            if not r["http"]:
                head["WARC-Type"] = "resource" if r["first"] is None else "revisit"
            head |= {"Content-Type": "application/http; msgtype=response" if r["http"] else r["mime"] or "application/octet-stream", "Content-Length": str(len(block))}
            out.append(("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n").encode() + block)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])


def write_warc(records: DataFrame, path: str) -> None:
    """Write planned records as WARC/1.1 files; the text sink's line separator is the end of a record."""
    _write_bytes(records.mapInArrow(_warc_records, "value binary"), path, "\r\n\r\n")


def warc_records(stream: io.BufferedReader) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every WARC record, by declared lengths."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        head = {}
        while (line := stream.readline()).strip():
            k, _, v = line.decode("utf-8", "replace").partition(":")
            head[k] = v.strip()
        yield head, stream.read(int(head["Content-Length"]))


def _parse_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for content in batch["content"].to_pylist():
                for h, block in warc_records(_stream(content)):
                    http, payload = _http(block)
                    if h["WARC-Type"] != "revisit":
                        n, digest = len(payload), hashlib.sha256(payload).hexdigest()
                    else:
                        n, digest = int(h["X-Payload-Length"]), h["WARC-Payload-Digest"].partition(":")[2]
                    yield h["WARC-Type"], h["WARC-Record-ID"], h.get("WARC-Refers-To"), _page_id(http), h["WARC-Target-URI"], h["WARC-Date"], n, digest, len(block)

    return _batches(rows(), _arrow(_WARC), lambda r: 300)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """A row per WARC record; length and digest of a response come from its payload as read, a revisit's from its header."""
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(_parse_warc, _WARC)


def archive_pages(pages: DataFrame, *, folder: str | None = None, **columns: str) -> DataFrame:
    """Pages to ARC files, ARC to WARC files with revisits, and back: one row per page.

    Returns page_id, payload_bytes, payload_digest, record_type and refers_to, the page id of the response that a
    revisit stands for. A null html or url is empty. Payloads are equal if their UTF-8 bytes are; those under 100
    bytes are always responses. Of repeated rows one is the response. Null ids are kept; as they rank last, they are
    responses only among themselves. An empty table gives no rows; other columns are not read. The files stay in
    ``folder``/arc and ``folder``/warc, or without a folder go once they are read back.
    """
    spark = pages.sparkSession
    path = new_path(spark, "warc-rows")
    with scratch(spark):
        arc, warc = (f"{folder.rstrip('/')}/{kind}" if folder else new_path(spark, kind) for kind in ("arc", "warc"))
        write_arc(pages, arc, **columns)
        write_warc(plan_revisits(read_arc(spark, arc)), warc)
        rows = read_warc(spark, warc).select("record_id", "refers_to_id", "page_id", "payload_bytes", "payload_digest", "record_type")
        back = stored(rows, "warc-rows", path)  # archives are parsed once
    responses = back.filter("record_type != 'revisit'").select(F.col("record_id").alias("_r"), F.col("page_id").alias("refers_to"))
    back = back.join(responses, back["refers_to_id"] == responses["_r"], "left")
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""

"""Operator 8: convert legacy ARC archives to WARC.

An ARC file begins with a version block, whose own lines say which fields the header line of
every record has; each header ends with the declared length of the record. The converter
reads by these lengths and synthesises what WARC wants and ARC lacks: record identifiers,
ISO dates, record types and digests. Of records with equal payloads of some size, one stays
a response and the others become revisits of it.

Files are written by Spark's text writer with the record separator as line separator, so they
are committed like any other output and may lie in any store; they are read back whole, which
``RECORDS_PER_FILE`` keeps small.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refillscope.llm.shared import in_bitmap, materialise, membership_bitmap, shared_path

# Records of a file; an archive's version block counts as one.
RECORDS_PER_FILE = 1000
# Payloads of fewer bytes are always stored.
REVISIT_BYTES = 1000

# Field names of the header lines of ARC versions 1 and 2.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE = b"X-Page-Id:"


def _arc_date(page_id: int | None) -> str:
    return (datetime(2001, 1, 1, tzinfo=UTC) + timedelta(seconds=(page_id or 0) % 10**8)).strftime("%Y%m%d%H%M%S")


def version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 corpus\n{FIELDS[version]}\n".encode()
    common = f"filedesc://{name} 0.0.0.0 20010101000000 text/plain"
    return (f"{common} {len(body)}\n" if version == 1 else f"{common} 200 - - 0 {name} {len(body)}\n").encode() + body


def arc_record(version: int, page_id: int | None, url: str | None, payload: bytes) -> bytes:
    """An ARC record of an HTTP response with the payload as its body."""
    mark = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n{mark}Content-Length: {len(payload)}\r\n\r\n".encode()
    common = f"{re.sub(r'\s', '%20', url or 'about:blank')} 0.0.0.0 {_arc_date(page_id)} text/html"
    size = len(head) + len(payload)
    line = f"{common} {size}\n" if version == 1 else f"{common} 200 {hashlib.md5(payload).hexdigest()} - 0 - {size}\n"
    return line.encode() + head + payload


def write_arc(pages: DataFrame, path: str) -> None:
    """Write ``page_id, url, html`` rows as ARC files; files alternate between versions 1 and 2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, n, version = [], 0, 2
        for batch in batches:
            for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                if n % RECORDS_PER_FILE == 0:
                    version = 3 - version
                    records.append(version_block(version, f"part-{n // RECORDS_PER_FILE}.arc"))
                    n += 1
                records.append(arc_record(version, page_id, url, (html or "").encode("utf-8", "surrogatepass")))
                n += 1
                if len(records) >= 200:
                    yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["record"])
                    records = []
        yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["record"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "record binary")
    _write(rows, path, "\n")


def _write(records: DataFrame, path: str, separator: str) -> None:
    """Write binary records to gzip files; casting to string leaves the bytes as they are.

    Compression is the fastest level: at the default one it costs more than all else here.
    """
    writer = records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", separator)
    writer = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _plain(content: bytes) -> bytes:
    """The bytes of a file: of all members if it is a gzip file."""
    out = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(content))
        content = member.unused_data
    return b"".join(out) if out else content


def parse_arc(raw: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """``(offset, header fields, content)`` of the records after the version block.

    Header lines have the fields that the version block names; a line that does not fit them
    is passed over, as are empty lines between records.
    """
    at, fields = 0, None
    while at < len(raw):
        end = raw.find(b"\n", at)
        end = len(raw) if end < 0 else end
        line = raw[at:end].decode("utf-8", "replace").rstrip("\r")
        parts = line.rsplit(" ", len(fields) - 1 if fields else 4)
        if not line or not parts[-1].isdigit() or (fields and len(parts) != len(fields)):
            at = end + 1
            continue
        start, size = end + 1, int(parts[-1])
        content = raw[start : start + size]
        if line.startswith("filedesc:"):
            named = content.decode("utf-8", "replace").splitlines()
            fields = next((x.split(" ") for x in named if x.startswith("URL ")), FIELDS[1].split(" "))
        elif fields:
            yield at, dict(zip(fields, parts, strict=True)), content
        at = start + size


def _http_parts(content: bytes) -> tuple[bytes, bytes]:
    head, mark, body = content.partition(b"\r\n\r\n")
    return (head + mark, body) if mark and head.startswith(b"HTTP/") else (b"", content)


def _http_number(head: bytes, name: bytes) -> int | None:
    for line in head.split(b"\r\n"):
        if line.lower().startswith(name.lower()):
            value = line[len(name) :].strip()
            return int(value) if re.fullmatch(rb"-?\d+", value) else None
    return None


_META = [
    ("page_id", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("url", pa.string()),
    ("ip", pa.string()), ("date", pa.string()), ("digest", pa.binary()), ("slot", pa.int64()), ("bytes", pa.int64()),
]
_META_SCHEMA = "page_id long, archive string, offset long, record_id string, url string, ip string, date string, digest binary, slot long, bytes long"


def _iso(date: str) -> str:
    """ISO form of an ARC date of up to 14 digits."""
    digits = (re.sub(r"\D", "", date) + "00010101000000"[len(re.sub(r"\D", "", date)) :])[:14]
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def _arc_records(with_content: bool, bitmap: Broadcast | None = None, repeated: bool = False):
    """Records of ARC files; with a bitmap only those whose payload digest is, or is not, in it."""
    names = [n for n, _ in _META] + ["head", "payload"] * with_content

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                archive, rows, held = path.rpartition("/")[2], [], 0
                for offset, fields, whole in parse_arc(_plain(content)):
                    head, payload = _http_parts(whole)
                    digest = hashlib.sha1(payload).digest()
                    slot = int.from_bytes(digest[:8], "big", signed=True)
                    record_id = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{offset}')}>"
                    row = (_http_number(head, _PAGE), archive, offset, record_id, fields["URL"], fields.get("IP-address", "0.0.0.0"), _iso(fields.get("Archive-date", "")), digest, slot, len(payload))
                    if bitmap is not None and bool(in_bitmap(bitmap.value, np.array([slot]))[0]) != repeated:
                        continue
                    rows.append(row + (head, payload) * with_content)
                    held += len(payload) * with_content
                    if held > 16_000_000:
                        yield packed(rows)
                        rows, held = [], 0
                yield packed(rows)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        types = [t for _, t in _META] + [pa.binary()] * 2 * with_content
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return run


def read_arc(spark: SparkSession, path: str, with_content: bool = True, bitmap: Broadcast | None = None, repeated: bool = False) -> DataFrame:
    """Records of ARC files (plain or gzip) under ``path``, with HTTP head and payload if wanted."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    schema = _META_SCHEMA + (", head binary, payload binary" if with_content else "")
    return files.mapInArrow(_arc_records(with_content, bitmap, repeated), schema)


def warc_record(row: dict) -> bytes:
    """A WARC/1.1 record without the separator after it; ``kept`` names the response a revisit points to."""
    kept = row.get("kept")
    block = row["head"] + (b"" if kept else row["payload"])
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if kept else 'response'}",
        f"WARC-Record-ID: {row['record_id']}",
        f"WARC-Date: {row['date']}",
        f"WARC-Target-URI: {row['url']}",
        f"WARC-IP-Address: {row['ip']}",
        f"WARC-Payload-Digest: sha1:{row['digest'].hex()}",
        f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kept:
        lines[-1:-1] = [
            f"WARC-Profile: {_PROFILE}",
            f"WARC-Refers-To: {kept['record_id']}",
            f"WARC-Refers-To-Target-URI: {kept['url']}",
            f"WARC-Refers-To-Date: {kept['date']}",
            *([] if kept["page_id"] is None else [f"X-Refers-To-Page: {kept['page_id']}"]),
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def _as_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            rows = batch.slice(at, 200).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([warc_record(r) for r in rows], pa.binary())], names=["record"])


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = REVISIT_BYTES) -> None:
    """Convert the ARC files under ``arc_path`` to WARC files in ``warc_path``.

    Of records with equal payloads of at least ``least`` bytes, that with the largest page id
    (nulls last; ties go to the last place in the archives) is the response, others revisit it.
    """
    meta = materialise(read_arc(spark, arc_path, with_content=False), "arc-records")
    best = F.max(F.struct("page_id", "archive", "offset", "record_id", "url", "date")).alias("kept")
    groups = meta.where(F.col("bytes") >= least).groupBy("digest", "slot").agg(best, F.count(F.lit(1)).alias("n"))
    groups = materialise(groups.where("n > 1"), "arc-repeats")
    bitmap = membership_bitmap(groups, "slot")
    # Only records that may be revisits are shuffled.
    alone = read_arc(spark, arc_path, True, bitmap, repeated=False).withColumn("kept", F.lit(None).cast(groups.schema["kept"].dataType))
    shared = read_arc(spark, arc_path, True, bitmap, repeated=True).join(groups.select("digest", "kept"), "digest", "left")
    own = (F.col("archive") == F.col("kept.archive")) & (F.col("offset") == F.col("kept.offset"))
    shared = shared.withColumn("kept", F.when(~own, F.col("kept")))
    _write(alone.unionByName(shared).mapInArrow(_as_warc, "record binary"), warc_path, "\r\n\r\n")


def parse_warc(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(headers, block)`` of the records of a WARC file, read by their declared lengths."""
    at = 0
    while (at := raw.find(b"WARC/", at)) >= 0:
        end = raw.index(b"\r\n\r\n", at)
        head = raw[at:end].decode().split("\r\n")[1:]
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in head)}
        start, size = end + 4, int(headers["content-length"])
        yield headers, raw[start : start + size]
        at = start + size


_READ_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, target_uri string, date string"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the WARC files under ``path``; a damaged payload is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _READ_SCHEMA.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
        for batch in batches:
            for content in batch.column("content").to_pylist():
                rows = []
                for headers, block in parse_warc(_plain(content)):
                    head, payload = _http_parts(block)
                    digest = headers["warc-payload-digest"].removeprefix("sha1:")
                    size = _http_number(head, b"Content-Length:")
                    if headers["warc-type"] == "response":
                        size = len(payload)
                        if hashlib.sha1(payload).hexdigest() != digest:
                            raise ValueError(f"damaged payload in record {headers['warc-record-id']}")
                    refers = headers.get("x-refers-to-page")
                    rows.append((_http_number(head, _PAGE), size, digest, headers["warc-type"], None if refers is None else int(refers), headers["warc-record-id"], headers["warc-target-uri"], headers["warc-date"]))
                columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, _READ_SCHEMA)


def pages_to_warc(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as ARC, convert to WARC, and read the archives back: a row per page.

    Reads ``page_id, url, html`` alone. Null html is an empty payload, a null url
    ``about:blank``; a null ``page_id`` stays null and is a response only where all equal
    payloads have none. Repeated rows are records of their own. An empty table gives an empty
    result.
    """
    spark = pages.sparkSession
    arc, warc = shared_path(spark, "arc"), shared_path(spark, "warc")
    write_arc(pages, arc)
    convert(spark, arc, warc)
    return read_warc(spark, warc)

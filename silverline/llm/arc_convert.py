"""Legacy ARC archives to WARC.

ARC: a file is a version block (`filedesc://` record whose body names the
version and the field list) and records, each one header line and as many bytes
as that line declares. The field list is version-specific: version 1 has five
fields, version 2 ten; the declared length is the last. The parser takes the
field list of the file it reads, counts bytes (never looks for separators), and
accepts header values that break the count of fields in the URL only.

Conversion keeps the payload and synthesises what ARC lacks: a record id
(urn:uuid, name-based on file, offset and URL, so a repeated conversion gives
the same id), an ISO timestamp from the 14 digits, a record type, block and
payload digests (base32 SHA-1). Of the records with equal payloads (from a
least length on) the one with the smallest key is the response, all others are
revisits that refer to it and carry no payload.

WARC files are written by Spark's text sink with the record separator CRLF CRLF
as line separator, gzip-compressed, so they go to any file system the session
can write. Reading back counts bytes by Content-Length, so payloads may hold
separators; digests are recomputed from the payload and compared.

Payloads are UTF-8 text. Defined cases: a null or empty payload has length 0
and is a payload like any other; a null URL is written as `-`, white space and
control characters in URLs are percent-encoded; rows without a key are not
archived. Repeated keys with equal payload give a response and a revisit to the
same key. Empty tables give an empty archive. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from silverline.catalog import scratch_path, stored
from silverline.llm.frames import only, rows_in

# ARC field lists by version, and the WARC version written.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
LEAST_DUPLICATE_BYTES = 0
FILE_RECORDS = 2_000
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")     # RFC 4122 URL name space
_BAD = re.compile(r"[\x00-\x20\x7f]")


def digest_of(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def clean_url(url: str | None) -> str:
    return _BAD.sub(lambda m: f"%{ord(m.group()):02X}", url) if url else "-"


# ---------------------------------------------------------------- ARC

@dataclass
class ArcRecord:
    offset: int
    fields: dict[str, str]
    payload: bytes


def arc_file(name: str, records: list[tuple[dict[str, str], bytes]], version: int = 2, date: str = "20000101000000") -> bytes:
    """An ARC file of (fields, payload) records; the length field is set here."""
    names = ARC_FIELDS[version]
    body = f"{version} 0 silverline\n{' '.join(names)}\n\n".encode()
    head = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/plain",
            "Result-code": "200", "Filename": name}
    out = bytearray()
    for fields, payload in [(head, body), *records]:
        values = {**fields, "Archive-length": str(len(payload)), "Offset": str(len(out))}
        out += (" ".join(values.get(n) or "-" for n in names) + "\n").encode()
        out += payload + b"\n"
    return bytes(out)


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC file of either version; the version block is not one.

    Raises ValueError where the file is cut short or a header line is no header."""
    at, names = 0, None
    while at < len(data):
        if data[at:at + 1] in b"\r\n":
            at += 1
            continue
        offset, stop = at, data.find(b"\n", at)
        if stop < 0:
            raise ValueError(f"no end of the header line at byte {offset}")
        line = data[at:stop].decode("utf-8", "replace").rstrip("\r")
        width = len(names) if names else 5 if line.count(" ") == 4 else 10
        parts = line.rsplit(" ", width - 1)
        if len(parts) != width or not parts[-1].isdigit():
            raise ValueError(f"no ARC header at byte {offset}: {line[:80]!r}")
        length = int(parts[-1])
        payload = data[stop + 1:stop + 1 + length]
        if len(payload) < length:
            raise ValueError(f"the record at byte {offset} declares {length} bytes, {len(payload)} are there")
        at = stop + 1 + length
        if names is None:
            lines = payload.decode("ascii", "replace").split("\n")
            if not parts[0].startswith("filedesc://") or len(lines) < 2 or not lines[0].split(" ")[0].isdigit():
                raise ValueError("the file does not begin with a version block")
            names = tuple(lines[1].strip().split(" "))
            if names not in ARC_FIELDS.values() or names != ARC_FIELDS.get(int(lines[0].split(" ")[0])):
                raise ValueError(f"unknown field list {names}")
            continue
        yield ArcRecord(offset, dict(zip(names, parts)), payload)


# ---------------------------------------------------------------- WARC

def record_id(file: str, offset: int, url: str) -> str:
    return f"urn:uuid:{uuid.uuid5(_SPACE, f'{file}#{offset}#{url}')}"


def iso_date(digits: str) -> str:
    """ISO 8601 of a 14-digit ARC date; the epoch where it is not one."""
    d = digits if re.fullmatch(r"\d{14}", digits or "") else "19700101000000"
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z"


def warc_headers(key: int, file: str, record: ArcRecord) -> tuple[str, str, str]:
    """Record id, payload digest, and the header lines common to both record types."""
    f = record.fields
    name, payload = record_id(file, record.offset, f["URL"]), digest_of(record.payload)
    return name, payload, CRLF.join([
        f"WARC-Record-ID: <{name}>", f"WARC-Date: {iso_date(f['Archive-date'])}", f"WARC-Target-URI: {f['URL']}",
        f"WARC-IP-Address: {f['IP-address']}", f"WARC-Payload-Digest: sha1:{payload}", f"WARC-Source-Key: {key}",
        f"WARC-Payload-Length: {len(record.payload)}"])


CONVERTED = "key bigint, id string, digest string, bytes bigint, headers string, mime string, payload string"


def _convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, url, text) rows to an ARC file per block of rows, and its records as WARC headers and payload."""
    names = [c.split()[0] for c in CONVERTED.split(", ")]
    task, n = TaskContext.get().partitionId(), 0
    for batch in rows_in(batches):
        keys, urls, texts = (c.to_pylist() for c in batch.columns)
        low, size = 0, 0
        for high in range(1, len(keys) + 1):
            size += len(texts[high - 1] or "")
            if size < 1 << 22 and high < len(keys):
                continue
            rows = [({"URL": clean_url(u), "IP-address": "0.0.0.0", "Archive-date": "20000101000000", "Content-type": "text/html",
                      "Result-code": "200"}, (t or "").encode()) for u, t in zip(urls[low:high], texts[low:high])]
            file = f"pages-{task}-{n}.arc"
            n += 1
            out = []
            for key, r in zip(keys[low:high], parse_arc(arc_file(file, rows))):
                name, digest, headers = warc_headers(key, file, r)
                out.append((key, name, digest, len(r.payload), headers, r.fields["Content-type"], r.payload.decode()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*out)], names)
            low, size = high, 0


def arc_to_warc(converted: DataFrame, path: str, least: int = LEAST_DUPLICATE_BYTES) -> None:
    """Writes converted ARC records as WARC files below `path`.

    The records are stored first: their ids hold the task that made them, so a
    second conversion, dealt otherwise, would not have the same ones. The
    smallest key of each payload is found by an aggregation of digests; the
    records themselves are shuffled once, by key, to meet their type."""
    converted = stored(converted, "converted", compression="zstd")
    slim = converted.select("key", "id", "digest", "bytes").where(F.col("bytes") >= least)
    first = slim.groupBy("digest", "bytes").agg(F.min(F.struct("key", "id")).alias("first"), F.count("*").alias("n")).where("n > 1")
    again = slim.join(first, ["digest", "bytes"]).where("id <> first.id").select(
        F.col("id").alias("again"), F.col("first.id").alias("to"), F.col("first.key").alias("to_key"))
    rows = converted.join(again, F.col("id") == F.col("again"), "left")
    revisit = F.col("to").isNotNull()
    refer = F.concat(F.lit(f"WARC-Refers-To: <"), "to", F.lit(f">{CRLF}WARC-Refers-To-Key: "), "to_key", F.lit(f"{CRLF}WARC-Profile: {REVISIT_PROFILE}{CRLF}"))
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    record = F.concat(
        F.lit(f"{WARC_VERSION}{CRLF}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit(CRLF), "headers", F.lit(CRLF),
        F.when(revisit, refer).otherwise(F.lit("")), F.lit("Content-Type: "), "mime",
        F.lit(f"{CRLF}Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF + CRLF), block)
    rows.select(record.alias("value")).write.option("lineSep", CRLF + CRLF).option("compression", "gzip") \
        .option("maxRecordsPerFile", FILE_RECORDS).text(path)


READ = ("key bigint, id string, type string, to string, to_key bigint, digest string, bytes bigint, payload_digest string, payload_bytes bigint")


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record, by declared lengths."""
    at = 0
    while at < len(data):
        stop = data.find(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8", "replace").split(CRLF) if stop >= 0 else []
        if not lines or not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        length = int(headers["Content-Length"])
        block = data[stop + 4:stop + 4 + length]
        if len(block) < length or data[stop + 4 + length:stop + 8 + length] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not hold the {length} bytes it declares")
        yield headers, block
        at = stop + 8 + length


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import gzip

    names = [c.split()[0] for c in READ.split(", ")]
    for batch in rows_in(batches):
        for i in range(batch.num_rows):
            out = []
            for h, block in parse_warc(gzip.decompress(batch.column(0)[i].as_py())):
                response = h["WARC-Type"] == "response"
                digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                if response and digest_of(block) != digest:
                    raise ValueError(f"{h['WARC-Record-ID']}: the payload does not have the digest in its header")
                out.append((int(h["WARC-Source-Key"]), h["WARC-Record-ID"][1:-1], h["WARC-Type"],
                            None if response else h["WARC-Refers-To"][1:-1], None if response else int(h["WARC-Refers-To-Key"]),
                            digest, int(h["WARC-Payload-Length"]), digest_of(block) if response else None, len(block) if response else None))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the WARC files below `path`: header values, and the digest and
    length computed from the payload itself (null for revisits). A task reads
    one file of at most FILE_RECORDS records at a time."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(_read, READ)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silverline.catalog import Tables

    pages = only(Tables(spark, sf_dir).pages, "page_id", "url", "html").where("page_id IS NOT NULL")
    path = scratch_path(spark, "warc")
    arc_to_warc(pages.mapInArrow(_convert, CONVERTED), path)
    return read_warc(spark, path).select(
        F.col("key").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("to_key").alias("refers_to"))


# Base32 of a 40-digit hex string in SQL: eight characters for every ten digits.
_BASE32_SQL = (
    "array_to_string(list_transform(range(0, 32), lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + "
    "((CAST('0x' || substr(d, 1 + 10 * (x // 8), 10) AS BIGINT) >> CAST(35 - 5 * (x % 8) AS INT)) & 31) AS INT), 1)), '')")

ORACLE = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_BASE32_SQL} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

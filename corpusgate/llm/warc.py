"""WARC archives with revisit resolution.

``resolve`` decides by payload digest which record is the response and which revisit it; ``write_archive`` writes one
WARC record per row, each with fresh headers, through Spark's own writer (so any store Spark can reach will do), and
``read_archive`` parses the files again and checks every digest and length.

A group of equal payloads of at least ``min_bytes`` has its largest key as response; all others revisit it.  Groups
are reduced to one row per digest before they meet the payloads, and the join leaves hot digests to Spark's skew
handling.  A null payload is empty; a row with a null key counts as smaller than any other; rows that repeat both key
and payload are of the same type.  Rows with a null url have no target URI.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from base64 import b32encode

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import base32_sha1

#: Fixed values of the archive format.
VERSION, CRLF = "WARC/1.1", "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = CRLF + CRLF
RECORD_URN = "urn:record:page:"


def resolve(pages: DataFrame, *, key: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest, refers_to`` (null: a response)."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    records = pages.select(
        F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload"),
    ).withColumns({
        "payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": base32_sha1(F.col("payload").cast("binary")),
    })
    headers = pages.select(
        F.col(key).cast("long").alias("page_id"), F.octet_length(body).cast("long").alias("n"),
        base32_sha1(body.cast("binary")).alias("payload_digest"),
    )
    originals = (
        headers.where(F.col("n") >= min_bytes).groupBy("payload_digest")
        .agg(F.max("page_id").alias("original"), F.count("*").alias("copies")).where("copies > 1 and original is not null")
        .select("payload_digest", "original")
    )
    later = F.col("page_id").isNull() | (F.col("page_id") < F.col("original"))
    return records.join(originals, "payload_digest", "left").withColumn("refers_to", F.when(later, F.col("original"))).drop("original")


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit(f"<{RECORD_URN}"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def record_text(date: Column) -> Column:
    """The whole record but for the two line ends that close it."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(END),
    )
    safe_url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    head = F.concat(
        F.lit(VERSION + CRLF),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("page_id"))),
        _line("WARC-Date", date),
        F.coalesce(_line("WARC-Target-URI", safe_url), F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(_line("WARC-Profile", F.lit(PROFILE)), _line("WARC-Refers-To", _urn(F.col("refers_to"))))).otherwise(""),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))).cast("string")),
        F.lit(CRLF),
    )
    return F.concat(head, http, F.when(revisit, "").otherwise(F.col("payload")))


def write_archive(resolved: DataFrame, path: str) -> None:
    """Gzip-compressed archive files below ``path``, written once; a failed task leaves no half file behind."""
    date = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    lines = resolved.select(record_text(date).alias("value"))
    lines.write.option("lineSep", END).option("compression", "gzip").text(path)


RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
_HEADER = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def _fields(block: bytes) -> dict[bytes, bytes]:
    return {k.lower(): v for k, v in _HEADER.findall(block)}


def parse_record(record: bytes):
    """The fields of one whole record; raises ValueError if a length or digest is wrong."""
    head, _, block = record.partition(END.encode())
    meta = _fields(head + CRLF.encode())
    http, _, payload = block.partition(END.encode())
    size, kind = int(_fields(http + CRLF.encode())[b"content-length"]), meta[b"warc-type"].decode()
    digest = meta[b"warc-payload-digest"].decode().removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload of {meta[b'warc-record-id']!r} does not match its header")

    def number(name):
        value = meta[name].decode().removeprefix(f"<{RECORD_URN}").removesuffix(">") if name in meta else "null"
        return None if value == "null" else int(value)

    uri = meta.get(b"warc-target-uri")
    return (number(b"warc-record-id"), None if uri is None else uri.decode("utf-8", "replace"), kind, size, digest,
            number(b"warc-refers-to"), payload if kind == "response" else None)


def whole_records(chunks):
    """Join the pieces between blank lines back into records, as long as each record's Content-Length says."""
    held, need = [], None
    for piece in chunks:
        if need is None:
            if not piece.startswith(VERSION.encode()):
                raise ValueError("a record does not start with its version")
            held = [piece]
            need = int(_fields(piece + CRLF.encode())[b"content-length"]) + len(piece) + len(END)
            size = len(piece)
        else:
            held.append(piece)
            size += len(END) + len(piece)
        if size >= need:
            if size != need:
                raise ValueError("a record is longer than its Content-Length")
            yield END.encode().join(held)
            need = None
    if need is not None:
        raise ValueError("the archive ends inside a record")


def read_archive(spark: SparkSession, path: str, *, payloads: bool = True) -> DataFrame:
    """Records of archive files.  A compressed file is read by one task, in order, one record at a time."""
    pieces = spark.read.option("lineSep", END).text(path).select(F.col("value").cast("binary").alias("value"))

    def parse(batches):
        def stream():
            for b in batches:
                yield from b.column("value").to_pylist()

        rows, size = [], 0

        def table():
            types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
            names = ("page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload")
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], list(names))

        for record in whole_records(stream()):
            row = parse_record(record)
            rows.append(row if payloads else (*row[:-1], None))
            size += len(record)
            if size > 4 << 20 or len(rows) >= 5000:
                yield table()
                rows, size = [], 0
        if rows:
            yield table()

    return pieces.mapInArrow(parse, RECORDS)

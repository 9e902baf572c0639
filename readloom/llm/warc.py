"""WARC archives of captured pages, and revisit resolution over them.

Records are lines of Spark's text sources: written with the last blank line as separator, read back at the version
line. Archives are gzip files, each read by one task from its start, so a payload that holds a version line of its
own is put together again by its Content-Length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage_path, stage_table

VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADERS = (
    "record_id string, page_id long, url string, captured string, record_type string, payload_digest string, "
    "payload_bytes long, refers_to long, refers_to_record string"
)


def _lines(*pairs: tuple[str, Column]) -> Column:
    """Header lines; one whose value is null is left out."""
    return F.concat(*[F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit("")) for name, value in pairs])


def write_archive(records: DataFrame, path: str) -> None:
    """records: the columns of HEADERS and payload string, null for revisits. One gzip file per partition.

    Every record gets its headers anew from its columns; a response's block is an HTTP header and the payload, a
    revisit's the HTTP header alone. Null ids and urls have no header line; white space in urls is percent-encoded.
    """
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\n"), _lines(("Content-Type", F.lit("text/html; charset=utf-8")), ("Content-Length", F.col("payload_bytes"))), F.lit("\r\n"))
    block = F.concat(http, F.coalesce(F.col("payload"), F.lit("")))
    revisit = F.col("record_type") == "revisit"
    headers = _lines(
        ("WARC-Type", F.col("record_type")),
        ("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        ("WARC-Date", F.col("captured")),
        ("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        ("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<"), F.col("refers_to_record"), F.lit(">")))),
        ("X-Page-Id", F.col("page_id")),
        ("X-Refers-To-Page-Id", F.when(revisit, F.col("refers_to"))),
        ("Content-Type", F.lit("application/http;msgtype=response")),
        ("Content-Length", F.octet_length("block")),
    )
    lines = records.withColumn("block", block).select(F.concat(F.lit(f"{VERSION}\r\n"), headers, F.lit("\r\n"), F.col("block"), F.lit("\r\n")).alias("value"))
    # the separator ends the blank line pair after each record
    lines.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("lineSep", "\r\n").text(path)


_FIELD = re.compile(rb"([^:\r\n]+): ([^\r\n]*)\r\n")


def _record(head: bytes, body: bytes, with_payload: bool) -> tuple:
    fields = dict(_FIELD.findall(head + b"\r\n"))
    http, _, payload = body.partition(b"\r\n\r\n")
    kind = fields[b"WARC-Type"].decode()
    digest = fields[b"WARC-Payload-Digest"].removeprefix(b"sha256:").decode()
    size = int(dict(_FIELD.findall(http + b"\r\n"))[b"Content-Length"])
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"record {fields[b'WARC-Record-ID'].decode()}: the payload isn't that of its headers")
    text = lambda name: None if name not in fields else fields[name].decode().strip("<>")
    number = lambda name: None if name not in fields else int(fields[name])
    row = (text(b"WARC-Record-ID"), number(b"X-Page-Id"), text(b"WARC-Target-URI"), text(b"WARC-Date"), kind, digest, size, number(b"X-Refers-To-Page-Id"), text(b"WARC-Refers-To"))
    return (*row, payload.decode() if kind == "response" else None) if with_payload else row


def read_archive(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records of the gzip archives under path, each checked against its length and digest."""
    schema = HEADERS + ", payload string" * with_payload
    names = [x.split()[0] for x in schema.split(", ")]
    start = f"{VERSION}\r\n".encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64() if n in ("page_id", "payload_bytes", "refers_to") else pa.string() for n in names]
        out: list[tuple] = []
        size, pending = 0, b""
        for batch in batches:
            for chunk in batch.column(0):
                pending = pending + start + chunk.as_py() if pending else chunk.as_py()
                head, found, rest = pending.partition(b"\r\n\r\n")
                if not found:  # what stands before a file's first version line is empty
                    if pending.strip():
                        raise ValueError("a record without headers")
                    pending = b""
                    continue
                length = int(head.rpartition(b"Content-Length: ")[2])
                if len(rest) < length + 4:  # the payload holds a version line
                    continue
                out.append(_record(head, rest[:length], with_payload))
                size, pending = size + len(rest), b""
                if size > 1 << 23 or len(out) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                    out, size = [], 0
        if pending:
            raise ValueError("the last record is cut off")
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    lines = spark.read.option("lineSep", start.decode()).text(path).select(F.col("value").cast("binary").alias("value"))
    return lines.mapInArrow(run, schema)


def capture(pages: DataFrame, path: str, captured: str = "2024-01-01T00:00:00Z") -> None:
    """Writes every row of pages (page_id, url, html) as a response. Null html is an empty payload."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    records = pages.select(
        F.concat(F.lit("urn:uuid:"), F.expr("uuid()")).alias("record_id"),
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.lit(captured).alias("captured"),
        F.lit("response").alias("record_type"),
        F.sha2(payload.cast("binary"), 256).alias("payload_digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.lit(None).cast("long").alias("refers_to"),
        F.lit(None).cast("string").alias("refers_to_record"),
        payload.alias("payload"),
    )
    write_archive(records, path)


def find_revisits(headers: DataFrame, least_bytes: int = 100) -> DataFrame:
    """record_id, refers_to, refers_to_record of the records that repeat another's payload.

    The original is the smallest page_id of a digest, null last, and of repeated rows the smallest record_id. Only
    headers are shuffled: originals are aggregated before the shuffle, stored, and joined by digest, where one
    digest may have any share of the records.
    """
    large = headers.where(F.col("payload_bytes") >= least_bytes)
    rank = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record_id")
    originals = large.groupBy("payload_digest").agg(F.min(rank).alias("o"), F.count("*").alias("n")).where("n > 1")
    originals = stage_table(originals.select("payload_digest", F.col("o.page_id").alias("refers_to"), F.col("o.record_id").alias("refers_to_record")), "warc-originals")
    return (
        large.select("record_id", "payload_digest")
        .join(originals, "payload_digest")
        .where("record_id <> refers_to_record")
        .select("record_id", "refers_to", "refers_to_record")
    )


def deduplicate(spark: SparkSession, source: str, target: str, least_bytes: int = 100) -> None:
    """Writes source's records to target, those that repeat a payload of at least least_bytes as revisits."""
    headers = stage_table(read_archive(spark, source), "warc-headers")
    revisits = stage_table(find_revisits(headers, least_bytes), "warc-revisits")
    records = read_archive(spark, source, with_payload=True).drop("record_type", "refers_to", "refers_to_record").join(revisits, "record_id", "left")
    repeats = F.col("refers_to_record").isNotNull()
    write_archive(records.withColumn("record_type", F.when(repeats, "revisit").otherwise("response")).withColumn("payload", F.when(~repeats, F.col("payload"))), target)


def archive_pages(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """Captures pages, deduplicates the archive and reads the result: the columns of HEADERS, a row per page.

    Repeated rows each have their record; null page_ids come back as null and are an original only where no other
    record has the payload; an empty table gives an archive without records. Other columns are not archived.
    """
    spark = pages.sparkSession
    raw, final = stage_path(spark, "warc-raw"), stage_path(spark, "warc-deduplicated")
    capture(pages.select("page_id", "url", "html"), raw)
    deduplicate(spark, raw, final, least_bytes)
    return read_archive(spark, final)

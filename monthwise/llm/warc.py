"""WARC archives with revisit records, written and read by Spark.

Headers are shuffled by payload digest to find each payload's original, every later holder becomes a revisit
record, and archives are written with fresh headers by Spark's text writer: the two line ends that close a WARC
record are the writer's line separator, so any file system Spark can write to will do. A file is one gzip
stream. Reading parses each archive by Content-Length and joins revisits back to their originals by digest.

Defined results: a null payload is empty; payloads under `least_bytes` are always responses; of equal payloads
the largest page_id is the response (a null id is the smallest; rows that repeat that id with the payload are
all responses); a null url leaves its header out; an empty table writes an archive without records; further
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_END = "\r\n\r\n"
_READ = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def payload_headers(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Adds payload, payload_bytes, payload_digest, and original: the page_id whose record a row revisits."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1(F.col("payload").cast("binary"))}
    )
    # Only the small headers are shuffled to find the originals; payload alone meets them again by page.
    originals = (
        rows.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("original"), F.count("*").alias("holders"))
        .where("holders > 1")
        .drop("holders")
    )
    joined = rows.join(originals, "payload_digest", "left")
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return joined.withColumn("original", F.when(revisit, F.col("original")))


def _record(date: str) -> Column:
    """One record without its closing line ends."""
    revisit = F.col("original").isNotNull()
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    record_id = lambda c: F.concat(F.lit("<urn:x-page:"), c, F.lit(">"))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    line = lambda name, value: F.concat(F.lit(f"\r\n{name}: "), value)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    return F.concat(
        F.lit("WARC/1.1"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", record_id(page)),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            line("WARC-Refers-To", record_id(F.col("original").cast("string"))),
        )).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n\r\n"),
        block,
    )


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 1000, file_records: int = 5000, date: str = "2026-01-01T00:00:00Z") -> None:
    """Writes one record per row, straight from the join by digest, into files of at most `file_records`."""
    (
        payload_headers(pages, least_bytes)
        .select(_record(date).alias("value"))
        .write.option("lineSep", RECORD_END)
        .option("maxRecordsPerFile", file_records)
        .option("compression", "gzip")
        .text(folder)
    )


def _records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        lines = data[at:head].decode("utf-8", "surrogateescape").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        body = head + 4
        end = body + int(fields["Content-Length"])
        yield fields, data[body:end]
        at = end + len(RECORD_END)


def _page(record_id: str | None) -> int | None:
    value = (record_id or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(value) if value.lstrip("-").isdigit() else None


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    names = [x.split()[0] for x in _READ.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    for batch in batches:
        for content in batch["content"]:
            data = zlib.decompress(content.as_buffer(), wbits=47)
            rows: list[tuple] = []
            for fields, block in _records(data):
                payload = block[block.index(b"\r\n\r\n") + 4 :]
                revisit = fields["WARC-Type"] == "revisit"
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if not revisit and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
                rows.append((
                    _page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), fields["WARC-Type"],
                    None if revisit else len(payload), digest, _page(fields.get("WARC-Refers-To")),
                    None if revisit else payload,
                ))
                if len(rows) == 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the archives; a revisit has no payload of its own."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    # One archive per Arrow batch row is enough: files are bounded when written.
    return files.select("content").mapInArrow(_parse, _READ)


def resolved(records: DataFrame, with_payload: bool = False) -> DataFrame:
    """Revisit records with the size (and payload) of the original they refer to."""
    keep = ["payload_bytes", *(["payload"] if with_payload else [])]
    originals = records.where("record_type = 'response'").groupBy("payload_digest").agg(
        *[F.first(c).alias(f"original_{c}") for c in keep]
    )
    revisits = records.where("record_type = 'revisit'").join(originals, "payload_digest", "left")
    base = ["page_id", "url", "record_type", "payload_digest", "refers_to"]
    first = records.where("record_type = 'response'").select(*base, *keep)
    return first.unionByName(revisits.select(*base, *[F.col(f"original_{c}").alias(c) for c in keep]))

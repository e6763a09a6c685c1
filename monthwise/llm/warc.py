"""WARC archives: writing captures as records, and assembling transactions.

Writing: every page becomes three records - request, response (or revisit) and
metadata - tied together by ``WARC-Concurrent-To``.  Of records with equal payloads of at
least ``min_bytes`` the one with the greatest page id is the response, the others
revisit it.  A record is one row of text whose line separator is the CR LF CR LF
that ends a WARC record, so Spark's own text writer makes the archives, on any file
system.  Pages are written by size class, larger ones fewer to a file, so an archive holds about
``archive_bytes`` before compression (and ``records_per_file`` records), or one capture that is larger.

Reading: archives are parsed file by file with record lengths taken from
``Content-Length``, never from the content.  Transaction assembly joins the records:
a request or metadata record is concurrent to a response, revisit, or to a request
that is itself concurrent to one.  One nested row per capture comes out.  Payloads
are shuffled once, with their response.

NULL html counts as an empty payload, NULL urls are left out of the records, NULL
page ids are written without one; repeated rows are written as captures of their own,
and of rows with equal ids and payloads one (the last read) is the response.  An
empty table makes no captures; columns besides page_id, url and html are not read, so none can
clash.  Memory: a task holds one archive at a time, and its payloads only if they are asked for.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.llm.common import fresh, written


RECORDS_PER_FILE = 3000
ARCHIVE_BYTES = 64 << 20
SMALL_PAGE = 64 << 10      # payloads up to this size make the first class; each further class is 16 times larger
CLASSES = 4
BATCH_BYTES = 8 << 20      # payloads that go to Spark at once
END = "\r\n\r\n"
BASE32HEX, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2024-01-01T00:00:00Z"      # captures carry no time of their own


def base32(hex_digest: Column) -> Column:
    """Upper-case base 32 of a 40-digit hex string: 5 hex digits make 4 digits."""
    parts = [F.lpad(F.conv(F.substring(hex_digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), BASE32HEX, BASE32)


def record_id(kind: str, row: Column) -> Column:
    """A stable urn:uuid from the kind of record and the page's row."""
    h = F.md5(F.concat(F.lit(kind + "|"), row))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def record(kind: str, headers: list[tuple[str, Column]], block: Column) -> Column:
    """A WARC record without the CR LF CR LF that ends it; NULL headers are left out."""
    lines = [F.concat(F.lit(f"{name}: "), value.cast("string")) for name, value in headers]
    return F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Date: {DATE}\r\n"), F.concat_ws("\r\n", *lines),
        F.lit("\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block)


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0,
                   records_per_file: int = RECORDS_PER_FILE, codec: str = "gzip",
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """``pages`` (page_id, url, html) as WARC archives below ``path``."""
    row = fresh(pages, "row")
    # Numbered once: a later scan of the same files may be split otherwise and number them anew.
    base = written(pages.select(
        F.monotonically_increasing_id().alias(row), F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.col("url").cast("string"), "[\r\n]", " ").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
    ).withColumn("hash", F.sha1("payload")).withColumn("bytes", F.octet_length("payload")), "captures")
    # One row per payload that occurs more than once: whom its copies refer to.
    kept = (base.where(F.col("bytes") >= min_bytes).select("hash", "page_id", row)
            .groupBy("hash").agg(F.max(F.struct("page_id", row)).alias("kept"), F.count("*").alias("n"))
            .where("n > 1").select("hash", F.col(f"kept.{row}").alias("to")))
    refers = (base.where(F.col("bytes") >= min_bytes).select("hash", row).join(kept, "hash")
              .where(F.col(row) != F.col("to")).select(row, "to"))
    refers = written(refers, "revisits")
    here = base.join(refers, row, "left").withColumn(row, F.col(row).cast("string"))
    capture = F.when(F.col("to").isNull(), record_id("response", F.col(row))).otherwise(
        record_id("revisit", F.col(row)))
    original = record_id("response", F.col("to").cast("string"))
    digest = F.concat(F.lit("sha1:"), base32(F.col("hash")))
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    common = [("WARC-Target-URI", F.col("url"))]
    response = record("response", [
        ("WARC-Record-ID", capture), *common, ("WARC-Payload-Digest", digest),
        ("Content-Type", F.lit("application/http;msgtype=response"))], F.concat(http, F.col("payload")))
    revisit = record("revisit", [
        ("WARC-Record-ID", capture), *common, ("WARC-Payload-Digest", digest), ("WARC-Refers-To", original),
        ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ("Content-Type", F.lit("application/http;msgtype=response"))], http)
    target = F.coalesce(F.regexp_extract("url", r"^[^:/]+://[^/]*(/[^\s#]*)", 1), F.lit(""))
    request = record("request", [
        ("WARC-Record-ID", record_id("request", F.col(row))), *common, ("WARC-Concurrent-To", capture),
        ("Content-Type", F.lit("application/http;msgtype=request"))],
        F.concat(F.lit("GET "), F.when(target == "", F.lit("/")).otherwise(target), F.lit(" HTTP/1.1\r\n\r\n")))
    metadata = record("metadata", [
        ("WARC-Record-ID", record_id("metadata", F.col(row))), *common,
        ("WARC-Concurrent-To", record_id("request", F.col(row))), ("Content-Type", F.lit("application/warc-fields"))],
        F.concat_ws("", F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit("\r\n"))))
    records = F.explode(F.array(F.when(F.col("to").isNull(), response).otherwise(revisit), request, metadata))
    in_use = {r[0] for r in base.select(size_class(F.col("bytes")).alias("class")).distinct().collect()}
    for of in sorted(in_use | {0}):                  # four classes at most; an empty table writes an empty folder
        captures = max(1, archive_bytes // (SMALL_PAGE * 16**of)) if of < CLASSES - 1 else 1
        (here.where(size_class(F.col("bytes")) == of).select(records.alias("value"))
         .write.mode("append").option("lineSep", END).option("compression", codec)
         .option("maxRecordsPerFile", min(records_per_file, 3 * captures)).text(path))


def size_class(size: Column) -> Column:
    """0 for payloads up to ``SMALL_PAGE`` bytes, then one more for every factor of 16."""
    bounds = [SMALL_PAGE * 16**i for i in range(CLASSES - 1)]
    return sum((F.when(size > b, 1).otherwise(0) for b in bounds), F.lit(0))


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of the records of an archive, by their lengths."""
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.index(b"\r\n\r\n", at)
        head = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            head[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
        length = int(head["content-length"])
        yield head, data[end + 4:end + 4 + length]
        at = end + 4 + length


RECORD_SCHEMA = ("record_id string, type string, concurrent_to string, refers_to string, uri string, "
                 "digest string, payload binary, payload_digest string, fields string")
SLIM_SCHEMA = RECORD_SCHEMA.replace("payload binary", "payload_bytes bigint")


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records below ``path``.  ``payload``: of a response, what follows its HTTP header (without
    ``payloads`` its length only, as ``payload_bytes``), with ``payload_digest`` computed from
    it; ``fields``: a metadata block."""
    schema = RECORD_SCHEMA if payloads else SLIM_SCHEMA
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        names = [f.split()[0] for f in schema.split(", ")]
        types = [{"payload": pa.binary(), "payload_bytes": pa.int64()}.get(n, pa.string()) for n in names]
        for batch in batches:
            for content in batch.column(0):
                data = content.as_py()
                if data[:2] == b"\x1f\x8b":           # one gzip member or many
                    parts = []
                    while data:
                        member = zlib.decompressobj(31)
                        parts.append(member.decompress(data))
                        data = member.unused_data
                    data = b"".join(parts)
                rows, held = [], 0
                for head, block in parse(data):
                    payload = sha = fields = None
                    if head["warc-type"] == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        sha = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if payloads:
                            held += len(payload)
                        else:
                            payload = len(payload)
                    elif head["warc-type"] == "metadata":
                        fields = block.decode("utf-8", "replace")
                    rows.append((head.get("warc-record-id"), head["warc-type"], head.get("warc-concurrent-to"),
                                 head.get("warc-refers-to"), head.get("warc-target-uri"),
                                 head.get("warc-payload-digest"), payload, sha, fields))
                    if len(rows) == 1000 or held > BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return files.mapInArrow(run, schema)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: record_id, type, uri, digest, refers_to, response
    (payload, its computed digest and size), requests and metadata as arrays of structs.  Of records
    read without payloads the response has digest and size only."""
    whole = "payload" in records.columns
    response = [*(["payload"] if whole else []), F.col("payload_digest").alias("digest"),
                (F.octet_length("payload").cast("long") if whole else F.col("payload_bytes")).alias("bytes")]
    request = records.where("type = 'request'").select(
        F.col("record_id").alias("request_id"), F.col("concurrent_to").alias("capture"), "uri")
    metadata = records.where("type = 'metadata'").select(
        F.col("record_id").alias("metadata_id"), F.col("concurrent_to").alias("beside"), "fields")
    # Metadata concurrent to a request belongs to what the request is concurrent to.
    metadata = metadata.join(request.select(F.col("request_id").alias("beside"), F.col("capture").alias("via")),
                             "beside", "left").select(
        F.coalesce("via", "beside").alias("capture"), "metadata_id", "fields")
    requests = request.groupBy("capture").agg(F.collect_list(F.struct("request_id", "uri")).alias("requests"))
    about = metadata.groupBy("capture").agg(F.collect_list(F.struct("metadata_id", "fields")).alias("metadata"))
    captures = records.where("type IN ('response', 'revisit')").select(
        F.col("record_id").alias("capture"), "type", "uri", "digest", "refers_to",
        F.when(F.col("type") == "response", F.struct(*response)).alias("response"))
    return captures.join(requests, "capture", "left").join(about, "capture", "left")


def transactions(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The captures of the archives below ``path`` (see :func:`assemble`).  Every archive is parsed
    once: its records, without payloads unless they are asked for, are written as a table."""
    return assemble(written(read_records(spark, path, payloads), "records"))


__all__ = ["transactions", "write_archives", "read_records", "assemble", "parse", "base32"]

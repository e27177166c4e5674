"""WARC archives: writing captures and reading them back as one nested row per transaction.

Writing: each capture becomes a request, a response (or a revisit of an earlier equal payload) and a metadata record; the
request and the metadata name the response in WARC-Concurrent-To. Spark's text writer stores the records, so files are committed as
any other job's output and survive a lost executor. Every file is a gzip stream of whole records.

Reading: each file is unpacked and walked record by record by Content-Length, never by searching for a marker, so payloads may hold anything. The records
of a transaction may lie in any files and any order; requests and metadata are joined to the response they name.

Defined results: a NULL payload is an empty one; a NULL URL is written as an empty target; repeated rows (equal page_id) are captures of their own with
one identifier for each page_id and payload; no pages give empty archives and no rows. Other columns are ignored.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SALTS = 32
# A file is in memory (compressed) while it is read: it holds at most so many captures, and of payloads over LARGE_BYTES so few that they
# stay under FILE_BYTES, or one.
FILE_CAPTURES, FILE_BYTES, LARGE_BYTES = 1_000, 64 << 20, 64 << 10
WARC_DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format

CRLF = "\r\n"
RECORDS = (
    "record_type string, record_id string, concurrent_to string, target string, fields map<string,string>, http string, payload binary"
)


def base32_sha1(hex_digest: Column) -> Column:
    """Base32 (upper case, 32 characters) of a SHA-1 in hexadecimal: each 40 bits are 8 digits to the base of 32."""
    digits = F.concat(*[F.lpad(F.conv(F.substring(hex_digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_first_copies(pages: DataFrame, min_bytes: int) -> DataFrame:
    """page_id, url, payload, its digest and size, and ``refers_to``: the smallest page_id with an equal payload, if that is another.

    Payloads are not shuffled by their digest: only ids are, dealt out by salt, and the answer returns by page.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html"), F.lit("")).alias("payload"))
    rows = rows.withColumn("sha1", F.sha1(F.encode("payload", "UTF-8"))).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    slim = rows.select("page_id", "sha1").where(F.col("payload_bytes") >= min_bytes)
    first = (
        slim.groupBy("sha1").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    later = (
        slim.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
        .join(first, ["sha1", "salt"]).where("page_id <> first_id").select("page_id", "sha1", "first_id").distinct()
    )
    return rows.join(later, ["page_id", "sha1"], "left").withColumnRenamed("first_id", "refers_to")


def _record(fields: list[tuple[str, Column]], block: Column) -> Column:
    """One record; the writer adds the last line feed."""
    head = [F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)) for name, value in fields]
    size = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF))
    return F.concat(F.lit("WARC/1.1" + CRLF), *head, size, F.lit(CRLF), block, F.lit(CRLF + "\r"))


def _uuid(*parts: Column) -> Column:
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(F.md5(F.concat_ws("|", *parts)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> None:
    """Write one transaction per row of ``pages`` (page_id, url, html) into new archives below ``folder``."""
    rows = with_first_copies(pages, min_bytes)
    page, target = F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "")
    own, digest = _uuid(F.lit("response"), page, F.col("sha1")), base32_sha1(F.col("sha1"))
    date, when = ("WARC-Date", F.lit(WARC_DATE)), F.col("refers_to").isNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(CRLF + CRLF),
    )
    shared = [("WARC-Target-URI", target), ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)), date]
    response = _record(
        [("WARC-Type", F.lit("response")), ("WARC-Record-ID", own), *shared, ("Content-Type", F.lit("application/http; msgtype=response"))],
        F.concat(http, F.col("payload")),
    )
    revisit = _record(
        [
            ("WARC-Type", F.lit("revisit")), ("WARC-Record-ID", own), *shared, ("WARC-Profile", F.lit(REVISIT)),
            ("WARC-Refers-To", _uuid(F.lit("response"), F.col("refers_to").cast("string"), F.col("sha1"))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        http,
    )
    about = [("WARC-Target-URI", target), ("WARC-Concurrent-To", own), date]
    host = F.regexp_extract(target, "://([^/?#]*)", 1)
    request = _record(
        [("WARC-Type", F.lit("request")), ("WARC-Record-ID", _uuid(F.lit("request"), page, F.col("sha1"))), *about, ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET / HTTP/1.1\r\nHost: "), host, F.lit(CRLF + CRLF)),
    )
    metadata = _record(
        [("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _uuid(F.lit("metadata"), page, F.col("sha1"))), *about, ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(
            F.lit("page-id: "), page, F.lit(CRLF + "refers-to-page: "), F.coalesce(F.col("refers_to").cast("string"), F.lit("")), F.lit(CRLF),
        ),
    )
    records = F.concat_ws("\n", request, F.when(when, response).otherwise(revisit), metadata)
    largest = pages.agg(F.max(F.octet_length("html"))).first()[0] or 0
    large = F.col("payload_bytes") > LARGE_BYTES
    parts = [(rows.where(~large), FILE_CAPTURES), (rows.where(large), max(1, FILE_BYTES // largest))] if largest > LARGE_BYTES else [(rows, FILE_CAPTURES)]
    for part, captures in parts:
        writer = part.select(records.alias("value")).write.mode("append").option("lineSep", "\n").option("compression", "gzip")
        writer.option("maxRecordsPerFile", captures).text(folder)


def walk_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of a file, plain or gzip, unpacked as it is walked.

    A file that is cut within a record, or a header without a length, raises.
    """
    stream = io.BytesIO(content)
    if content[:2] == b"\x1f\x8b":
        stream = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 20)
    while True:
        line = stream.readline()
        while line and not line.strip():
            line = stream.readline()
        if not line:
            return
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError(f"record cut short: {len(block)} of {size} bytes")
        yield fields, block


def _row(fields: dict[str, str], block: bytes) -> tuple:
    """A record's columns; the block of an HTTP message is split into its head and its payload."""
    http = None
    if fields.get("content-type", "").startswith("application/http"):
        head, _, block = block.partition(b"\r\n\r\n")
        http = head.decode("utf-8", "replace")
    names = ("warc-type", "warc-record-id", "warc-concurrent-to", "warc-target-uri")
    return *(fields.get(n) for n in names), list(fields.items()), http, block


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives below ``folder``; ``fields`` has the header, names in lower case."""
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [*[pa.string()] * 4, pa.map_(pa.string(), pa.string()), pa.string(), pa.binary()]
        names = ["record_type", "record_id", "concurrent_to", "target", "fields", "http", "payload"]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for fields, block in walk_records(content.as_py()):
                    rows.append(_row(fields, block))
                    size += len(block)
                    if len(rows) >= 2_000 or size >= 16_000_000:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return files.mapInArrow(records, RECORDS)


def assemble(records: DataFrame, parts: tuple[str, ...] = ("record_id", "fields", "http", "payload")) -> DataFrame:
    """One nested row per capture: record_id, target, kind (response or revisit) and the structs response, request and metadata.

    ``parts`` names the columns of a record that go into its struct; only these are shuffled. A response that no request or
    metadata record names has NULL there. Of several that name one response, the smallest record id is taken.
    """
    part = F.struct(*parts)
    captures = records.where("record_type in ('response', 'revisit')").select(
        "record_id", "target", F.col("record_type").alias("kind"), part.alias("response")
    )

    def concurrent(kind: str) -> DataFrame:
        return (
            records.where((F.col("record_type") == kind) & F.col("concurrent_to").isNotNull())
            .groupBy(F.col("concurrent_to").alias("record_id"))
            .agg(F.min_by(part, "record_id").alias(kind))
        )

    return captures.join(concurrent("request"), "record_id", "left").join(concurrent("metadata"), "record_id", "left")

"""Archives of web captures: write request, response (or revisit) and metadata records, read them, assemble.

The archive is written by Spark's text sink: a record is a row of UTF-8 text, and the sink's separator is the
blank lines that end a record, so a part file is a plain WARC file (gzip-compressed as a whole).  The sink's
commit makes retried tasks harmless.  Reading parses part files by their length headers; the three records of a
capture meet again through WARC-Concurrent-To, and a revisit finds the record it refers to through
WARC-Refers-To.

Defined results: a null html is an empty payload; a null url is left out of the headers; every row is a capture of
its own, identical rows are told apart by a number in their record ids; a row without an id is a capture without an
id; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retailflow.llm.common import batches, new_path, saved

# Fixed values of the archive format.
CRLF = "\r\n"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = pa.schema([
    ("record_id", pa.string()), ("kind", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()),
    ("uri", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("fields", pa.string()),
])
RECORDS_SQL = ("record_id string, kind string, concurrent_to string, refers_to string, uri string, page_id long, "
               "payload_bytes long, payload_digest string, fields string")


def capture_name(page: Column, url: Column, digest: Column) -> Column:
    """What a capture holds, as one value; a missing url differs from every url."""
    return F.sha1(F.concat_ws("\n", F.coalesce(page.cast("string"), F.lit("-")),
                              F.coalesce(F.concat(F.lit("+"), url), F.lit("-")), digest))


def record_id(kind: str, name: Column, number: Column) -> Column:
    """An id made from what the record holds and its number among equal rows, so a retried task writes the same one."""
    name = F.sha1(F.concat_ws("\n", F.lit(kind), name, number.cast("string")))
    parts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def captures(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """One row per page with its payload, digest, number among equal rows and, where an equal payload has a later page,
    that page.

    Payloads are shuffled once, by what tells captures apart; the search for equal payloads goes without them.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long"))
    rows = rows.withColumn("name", capture_name(F.col("page_id"), F.col("url"), F.col("digest")))
    owners = (
        rows.where(F.col("size") >= min_bytes).groupBy("digest")
        .agg(F.max(F.struct("page_id", "url")).alias("owner"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("digest", "owner")
    )
    revisits = (
        rows.select("name", "page_id", "digest").join(owners.hint("shuffle_hash"), "digest")
        .where(~F.col("page_id").eqNullSafe(F.col("owner.page_id"))).select("name", "owner").distinct()
    )
    # Equal rows are the same in all that is written, so it does not matter which one gets which number.
    number = F.row_number().over(Window.partitionBy("name").orderBy("name"))
    return rows.join(revisits.hint("shuffle_hash"), "name", "left").withColumn("number", number)


def _record(headers: list[Column], block: Column) -> Column:
    """Headers (null ones are left out), the block's length, a blank line, the block."""
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    return F.concat(F.concat_ws(CRLF, F.lit(VERSION), *headers, length), F.lit(CRLF * 2), block)


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def records(rows: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Three records of text per capture, in one column ``value``."""
    url, digest, name, number = F.col("url"), F.col("digest"), F.col("name"), F.col("number")
    revisit = F.col("owner").isNotNull()
    main = record_id("response", name, number)
    target = record_id("response", capture_name(F.col("owner.page_id"), F.col("owner.url"), digest), F.lit(1))
    safe = F.regexp_replace(url, r"[\x00-\x20]", "%20")
    uri, at, to = _line("WARC-Target-URI", safe), F.lit(f"WARC-Date: {date}"), _line("WARC-Concurrent-To", main)
    http = F.concat(F.lit(CRLF.join(("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "))),
                    F.col("size").cast("string"), F.lit(CRLF * 2))
    answer = _record(
        [_line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), _line("WARC-Record-ID", main), uri, at,
         _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
         F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")), F.when(revisit, _line("WARC-Refers-To", target)),
         F.lit("Content-Type: application/http;msgtype=response")],
        F.when(revisit, http).otherwise(F.concat(http, F.col("payload"))))
    host = F.coalesce(F.regexp_extract(safe, r"^[a-zA-Z]+://([^/?#]*)", 1), F.lit("-"))
    request = _record(
        [F.lit("WARC-Type: request"), _line("WARC-Record-ID", record_id("request", name, number)), uri, at, to,
         F.lit("Content-Type: application/http;msgtype=request")],
        F.concat(F.lit("GET "), F.coalesce(safe, F.lit("-")), F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(CRLF * 2)))
    fields = F.to_json(F.struct("page_id", "url"))
    metadata = _record(
        [F.lit("WARC-Type: metadata"), _line("WARC-Record-ID", record_id("metadata", name, number)), uri, at, to,
         F.lit("Content-Type: application/warc-fields")],
        F.concat(F.lit("capture: "), fields, F.lit(CRLF)))
    return rows.select(F.explode(F.array(request, answer, metadata)).alias("value"))


def write_archive(pages: DataFrame, path: str, min_bytes: int = 1000, records_per_file: int = 3000) -> str:
    """Write a folder of archives; ``records_per_file`` bounds what one reader holds."""
    (records(captures(pages, min_bytes)).write.option("lineSep", CRLF * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))
    return path


def parse_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an uncompressed archive."""
    at, end = 0, len(content)
    while at < end:
        stop = content.index(b"\r\n\r\n", at)
        first, *lines = content[at:stop].decode().split(CRLF)
        if first != VERSION:
            raise ValueError(f"no record starts at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines)
        begin = stop + 4
        at = begin + int(headers["Content-Length"])
        yield headers, content[begin:at]
        if content[at:at + 4] != b"\r\n\r\n":
            raise ValueError(f"the record before byte {at} has another length")
        at += 4


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; a response's payload is measured and its digest compared with the header."""

    def parse(parts):
        def rows():
            for part in parts:
                for content in part.column(0):
                    for headers, block in parse_archive(zlib.decompress(content.as_py(), 31)):
                        kind = headers["WARC-Type"]
                        size = digest = page = fields = None
                        if kind == "response":
                            payload = block[block.index(b"\r\n\r\n") + 4:]
                            size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                            if headers["WARC-Payload-Digest"] != f"sha1:{digest}":
                                raise ValueError(f"damaged payload in {headers['WARC-Record-ID']}")
                        elif kind == "metadata":
                            fields = block.decode().removeprefix("capture: ").rstrip("\r\n")
                            page = json.loads(fields).get("page_id")
                        yield (headers["WARC-Record-ID"], kind, headers.get("WARC-Concurrent-To"),
                               headers.get("WARC-Refers-To"), headers.get("WARC-Target-URI"), page, size, digest,
                               fields)

        yield from batches(rows(), RECORDS)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(parse, RECORDS_SQL)


def assemble(rows: DataFrame) -> DataFrame:
    """One nested row per capture: ``record_id, request, response, metadata``, joined by concurrent-to."""
    parts = F.struct("record_id", "kind", "uri", "refers_to", "page_id", "payload_bytes", "payload_digest", "fields")
    one = lambda *kinds: F.max(F.when(F.col("kind").isin(*kinds), parts))
    return (
        rows.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id"))
        .agg(one("request").alias("request"), one("response", "revisit").alias("response"),
             one("metadata").alias("metadata"))
    )


def resolved(assembled: DataFrame) -> DataFrame:
    """Add ``original``: for a revisit, the capture it refers to."""
    originals = assembled.where("response.kind = 'response'").select(
        F.col("capture_id").alias("original_id"),
        F.struct(F.col("metadata.page_id").alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"),
                 F.col("response.payload_digest").alias("payload_digest")).alias("original"))
    return assembled.join(originals, F.col("response.refers_to") == F.col("original_id"), "left").drop("original_id")


def round_trip(pages: DataFrame, min_bytes: int = 1000, path: str | None = None) -> DataFrame:
    """Write the pages to an archive, read it back, and return one assembled row per capture."""
    spark = pages.sparkSession
    folder = write_archive(pages, path or new_path(spark, "warc"), min_bytes)
    return resolved(saved(assemble(read_records(spark, folder)), "captures"))

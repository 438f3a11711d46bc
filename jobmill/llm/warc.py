"""WARC archives of pages: written as request, response and metadata records, read back, and
assembled into one nested row per capture."""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmill.llm.common import attach, drop, numbered, store
from jobmill.session import shared_dir

#: Equal payloads of at least so many bytes are stored once.
LEAST_BYTES = 0
#: Most bytes of payload in one file, as far as no single capture is larger.
FILE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
# The line ends, version and revisit profile of the format.
CRLF = "\r\n"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# The digits of base 32 in Java's numbers and in RFC 4648.
JAVA_32, RFC_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORDS = (
    "record_id string, type string, concurrent_to string, refers_to string, target_uri string, date string, "
    "payload_digest string, payload_bytes long, found_digest string, fields string, payload binary"
)


def base32(digits: Column) -> Column:
    """Bare upper-case base 32 of a SHA-1 in hex: five digits of hex are four of base 32."""
    parts = [F.lpad(F.conv(F.substring(digits, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*parts), JAVA_32, RFC_32)


def record_id(kind: str, row: Column) -> Column:
    d = F.md5(F.concat_ws(":", F.lit(kind), row.cast("string")))
    parts = [F.substring(d, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def record(kind: Column, name: Column, uri: Column, extra: Column, mime: str, block: Column) -> Column:
    """One record without the two line ends that close it."""
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), name),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        extra,
        F.lit(f"Content-Type: {mime}"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2), block)


def write_archives(pages: DataFrame, path: str, least: int = LEAST_BYTES) -> None:
    """Three records per page: response or revisit, request and metadata, gzipped file by file.

    Of pages with equal payloads of at least ``least`` bytes the one with the largest id (of
    rows that repeat it, the last) is a response and the others revisit it. Only digests and
    ids are grouped, a group's rows are not moved to its key's task when there are many;
    then every page meets its decision once. A null page has an empty payload; a null
    address is written empty; line ends in an address become blanks.
    """
    html = F.coalesce("html", F.lit(""))
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", " ")
    stored, number = numbered(pages.select("page_id", "url", "html"), "zstd")
    rows = stored.select(F.col(number).alias("row"), "page_id", uri.alias("uri"), html.alias("html")).withColumns({"digest": base32(F.sha1(F.encode("html", "UTF-8"))), "bytes": F.octet_length("html").cast("long")})
    narrow = store(rows.select("row", "page_id", "digest", "bytes"), "payloads")
    total, largest = narrow.agg(F.count(F.lit(1)), F.max("bytes")).first()
    last = F.max(F.struct(F.col("page_id").isNotNull().alias("_has"), F.col("page_id"), F.col("row").alias("response_row")))
    groups = narrow.where(F.col("bytes") >= least).groupBy("digest", "bytes").agg(
        last.alias("_last"), F.count(F.lit(1)).alias("_n")
    )
    groups = store(groups.where("_n > 1"), "payload-groups")
    again = attach(narrow, groups, ["digest", "bytes"], "_n", total).where(F.col("row") != F.col("_last.response_row"))
    revisits = again.select("row", F.col("_last.response_row").alias("response_row"))
    decided = rows.join(revisits, "row", "left")
    revisit = F.col("response_row").isNotNull()
    own = record_id("response", F.col("row"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(CRLF * 2),
    )
    link = F.concat(F.lit("WARC-Concurrent-To: "), own)
    extra = F.concat(
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(
            revisit,
            F.concat(F.lit(f"{CRLF}WARC-Profile: {PROFILE}{CRLF}WARC-Refers-To: "), record_id("response", F.col("response_row"))),
        ).otherwise(F.lit("")),
    )
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    get = F.concat(F.lit("GET "), F.col("uri"), F.lit(f" HTTP/1.1{CRLF}{CRLF}"))
    fields = F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(CRLF))
    target = F.col("uri")
    three = F.array(
        record(F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), own, target, extra, "application/http;msgtype=response", body),
        record(F.lit("request"), record_id("request", F.col("row")), target, link, "application/http;msgtype=request", get),
        record(F.lit("metadata"), record_id("metadata", F.col("row")), target, link, "application/warc-fields", fields),
    )
    captures = max(1, min(1024, FILE_BYTES // max(1, largest or 1)))
    (
        decided.select(F.explode(three).alias("value"))
        .write.option("lineSep", CRLF * 2)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", 3 * captures)
        .text(path)
    )
    drop(stored, narrow, groups)


def parsed(source: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of a stream; a block is taken by its length."""
    while True:
        line = source.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := source.readline()).strip():
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, source.read(int(headers["content-length"]))


def record_row(headers: dict[str, str], block: bytes, payloads: bool) -> tuple:
    kind = headers.get("warc-type")
    size = found = payload = fields = None
    if kind in ("response", "revisit"):
        head, _, body = block.partition(b"\r\n\r\n")
        http = dict(x.lower().split(b":", 1) for x in head.split(b"\r\n")[1:] if b":" in x)
        if kind == "response":
            size, found = len(body), hashlib.sha1(body).hexdigest()
            payload = body if payloads else None
        else:
            size = int(http.get(b"content-length", b"0"))
    elif kind == "metadata":
        fields = block.decode()
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    named = [headers.get(f"warc-{x}") for x in ("record-id", "type", "concurrent-to", "refers-to", "target-uri", "date")]
    return (*named, digest, size, found, fields, payload)


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the gzipped archives below ``path``, one row each.

    Files are streamed record by record; rows leave a task in batches of at most 256 rows or
    8 MB of payload. ``found_digest`` is the hex SHA-1 of the payload that was read.
    """
    names = [x.split(" ")[0] for x in RECORDS.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows, held = [], 0
                for headers, block in parsed(gzip.GzipFile(fileobj=io.BytesIO(content))):
                    rows.append(record_row(headers, block, payloads))
                    held += len(block) if payloads else 0
                    if len(rows) == 256 or held > 8 << 20:
                        yield pd.DataFrame(rows, columns=names).astype({"payload_bytes": "Int64"})
                        rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names).astype({"payload_bytes": "Int64"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInPandas(read, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: ``record_id, type, target_uri`` and the structs ``capture``,
    ``request`` and ``metadata``, joined through the identifiers they are concurrent to.

    Each identifier names one capture, so no key is hot. A capture without a request or
    metadata record has null there; records that belong to no capture are left out.
    """
    about = F.struct("refers_to", "date", "payload_digest", "payload_bytes", "found_digest", "payload").alias("capture")
    captures = records.where(F.col("type").isin("response", "revisit")).select("record_id", "type", "target_uri", about)
    requests = records.where("type = 'request'").select(
        F.col("concurrent_to").alias("_to"), F.struct("record_id", "date").alias("request")
    )
    metadata = records.where("type = 'metadata'").select(
        F.col("concurrent_to").alias("_of"), F.struct("record_id", "fields").alias("metadata")
    )
    return (
        captures.join(requests, captures["record_id"] == requests["_to"], "left")
        .join(metadata, captures["record_id"] == metadata["_of"], "left")
        .drop("_to", "_of")
    )


def page_captures(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Write the pages, read the archives back, and give one row per page:
    ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    A response whose payload does not have the digest of its header, or a page without a
    capture of its own, raises an error. An empty table gives no rows.
    """
    spark = pages.sparkSession
    path = shared_dir(spark, "warc")
    write_archives(pages, path, least)
    records = store(read_records(spark, path, payloads=False), "records")
    digest = base32(F.col("capture.found_digest"))
    page = F.regexp_extract("metadata.fields", r"page-id: (-?\d+)", 1)
    known = store(
        assemble(records).select(
            "record_id",
            F.when(page != "", page.cast("long")).alias("page_id"),
            F.col("capture.payload_bytes").alias("payload_bytes"),
            F.col("capture.payload_digest").alias("payload_digest"),
            F.col("type").alias("record_type"),
            F.col("capture.refers_to").alias("target"),
            digest.alias("_found"),
        ),
        "captures",
    )
    total = known.count()
    bad = known.where("record_type = 'response' AND NOT _found <=> payload_digest").limit(1).count()
    if bad:
        raise ValueError("a payload does not have the digest of its record")
    uses = known.where("target IS NOT NULL").groupBy("target").agg(F.count(F.lit(1)).alias("_n"))
    targets = known.select(F.col("record_id").alias("target"), F.col("page_id").alias("refers_to")).join(uses, "target")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    again = attach(known.where("target IS NOT NULL"), store(targets, "targets"), ["target"], "_n", total)
    first = known.where("target IS NULL").withColumn("refers_to", F.lit(None).cast("long"))
    return first.select(*columns).unionByName(again.select(*columns))

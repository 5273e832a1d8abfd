"""WARC archives: writing pages as transactions, reading records back, assembling captures."""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.operators.sizing import broadcast_within, measured

RECORDS_PER_FILE = 3000
END = "\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "type string, record_id string, concurrent_to string, target_uri string, refers_to string, "
    "payload_digest string, payload_bytes bigint, payload binary, block string, path string"
)


def payload_digest(payload: Column) -> Column:
    """Base32 SHA-1, upper case: five bits a sign, forty bits at a time."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(kind: str, *identity: Column) -> Column:
    """A name-based id: rows that agree in page, address and payload have the same."""
    parts = [F.coalesce(c.cast("string"), F.lit("\0")) for c in identity]
    name = F.md5(F.concat_ws("\n", F.lit(kind), *parts))
    cuts = [F.substring(name, i, n) for i, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _record(kind: str, headers: dict[str, Column | str], block: Column) -> Column:
    """A record without its closing blank lines; headers that are null are left out."""
    lines = [F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Date: {DATE}")]
    for name, value in headers.items():
        lines.append(F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value))
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def header_text(value: Column) -> Column:
    """A value that fits in one header line: control characters are percent-encoded."""
    plain = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.regexp_replace(plain, r"[\x00-\x1F]", "%00")


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Add payload, digest and ``first_id``, ``first_url``: the page that a payload is kept for.

    Only payloads that occur twice are joined back, so single pages are not
    shuffled while that list is short enough to broadcast.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select("page_id", "url", payload.alias("html"), payload_digest(payload.cast("binary")).alias("digest"))
    keyed = keyed.withColumn("payload_bytes", F.octet_length("html").cast("bigint"))
    once = keyed.where(F.col("payload_bytes") >= min_bytes).groupBy("digest")
    firsts = once.agg(F.count("*").alias("n"), F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", F.coalesce("url", F.lit("\0")).alias("url")))).alias("first"))
    firsts = firsts.where("n > 1").select("digest", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"))
    firsts, n = measured(firsts)
    return keyed.join(broadcast_within(firsts, n, 200_000), "digest", "left")


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write request, response (or revisit) and metadata records of ``page_id``, ``url``, ``html`` rows.

    Of rows with equal payloads of at least ``min_bytes`` bytes, those with the smallest page id are
    responses and the others revisit them; a null page id counts as larger than
    all, and rows that all lack one are responses. A null html is an empty
    payload. Spark's text writer makes the files: a record is a row and the
    blank lines after it are the line separator, so any file system of Spark
    serves and nothing is held in memory. Other columns are left out.
    """
    rows = with_revisits(pages, min_bytes)
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    rows = rows.withColumn("revisit", again)
    url = header_text(F.coalesce("url", F.lit("")))
    identity = (F.col("page_id"), F.coalesce("url", F.lit("\0")), F.col("digest"))
    main = _record_id("response", *identity)
    first = _record_id("response", F.col("first_id"), F.col("first_url"), F.col("digest"))
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    kind = "application/http; msgtype=response"
    common = {"WARC-Record-ID": main, "WARC-Target-URI": url, "WARC-Payload-Digest": digest, "Content-Type": kind}
    response = _record("response", common, F.concat(http, F.col("html")))
    revisit = _record("revisit", {**common, "WARC-Profile": IDENTICAL, "WARC-Refers-To": first}, http)
    host = F.coalesce(F.parse_url(F.when(F.col("url").rlike(r"^[a-z]+://[A-Za-z0-9.:-]+([/?#][!-~]*)?$"), F.col("url")), F.lit("HOST")), F.lit(""))
    asked = F.concat(F.lit("GET "), url, F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END))
    request_id, metadata_id = _record_id("request", *identity), _record_id("metadata", *identity)
    beside = {"WARC-Concurrent-To": main, "WARC-Target-URI": url}
    request = _record("request", {"WARC-Record-ID": request_id, **beside, "Content-Type": "application/http; msgtype=request"}, asked)
    fields = F.concat_ws(
        "\r\n",
        F.concat(F.lit("page-id: "), F.col("page_id").cast("string")),
        F.concat(F.lit("refers-to-page: "), F.when(F.col("revisit"), F.col("first_id")).cast("string")),
    )
    metadata = _record("metadata", {"WARC-Record-ID": metadata_id, **beside, "Content-Type": "application/warc-fields"}, fields)
    records = F.array(request, F.when(F.col("revisit"), revisit).otherwise(response), metadata)
    lines = rows.select(F.explode(records).alias("value"))
    options = {"lineSep": END, "compression": "gzip", "maxRecordsPerFile": records_per_file}
    lines.write.options(**options).text(path)


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case, the type under ``warc-type``) and block of each record."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    place = 0
    while place < len(data):
        end = data.find(b"\r\n\r\n", place)
        if end < 0 or not data.startswith(b"WARC/", place):
            raise ValueError(f"no WARC record at byte {place}")
        lines = data[place:end].decode("utf-8", "replace").split("\r\n")
        headers = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
        start, size = end + 4, int(headers["content-length"])
        if start + size > len(data):
            raise ValueError(f"record at byte {place} is cut off")
        yield headers, data[start : start + size]
        place = start + size + 4


def read_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            rows = []
            for headers, block in parse_archive(content.as_py()):
                kind = headers.get("warc-type")
                digest = (headers.get("warc-payload-digest") or "").removeprefix("sha1:") or None
                payload, size, text = None, None, None
                if kind in ("response", "revisit"):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = len(payload)
                    if kind == "response":
                        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    else:
                        fields = (line.partition(b":") for line in http.split(b"\r\n")[1:])
                        size = next((int(value) for name, _, value in fields if name.strip().lower() == b"content-length"), None)
                        payload = None
                else:
                    text = block.decode("utf-8", "replace")
                ids = [headers.get(k) for k in ("warc-record-id", "warc-concurrent-to", "warc-target-uri", "warc-refers-to")]
                rows.append((kind, *ids, digest, size, payload, text, path.as_py()))
            types = [pa.string()] * 6 + [pa.int64(), pa.binary(), pa.string(), pa.string()]
            names = [x.split()[0] for x in RECORD.split(", ")]
            columns = zip(*rows, strict=True) if rows else [[] for _ in types]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives below ``path``, gzipped or plain.

    Each archive is read whole by one task, as records can only be told apart
    from the start; a broken archive fails the read. The digest of a response
    is computed from its payload, that of a revisit is the declared one.
    """
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    return files.mapInArrow(read_records, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: response or revisit with its request and metadata.

    Records meet by the id that requests and metadata name as concurrent. Equal
    ids mean equal records, so repeats are counted, not gathered, and give one
    row each; a capture without request or metadata has null there, and records
    that are concurrent to no known response are left out.
    """
    main = F.col("type").isin("response", "revisit")
    keyed = records.where("type IN ('request', 'response', 'revisit', 'metadata')")
    keyed = keyed.withColumn("capture", F.when(main, F.col("record_id")).otherwise(F.col("concurrent_to")))

    def first(condition: Column, column: str) -> Column:
        return F.first(F.when(condition, F.col(column)), ignorenulls=True)

    request, metadata = F.col("type") == "request", F.col("type") == "metadata"
    wanted = ("type", "target_uri", "refers_to", "payload_digest", "payload_bytes", "payload")
    found = keyed.groupBy("capture").agg(
        F.count(F.when(main, 1)).alias("copies"),
        *[first(main, c).alias(c) for c in wanted],
        first(request, "record_id").alias("request_id"),
        first(request, "block").alias("request_block"),
        first(metadata, "record_id").alias("metadata_id"),
        first(metadata, "block").alias("metadata_block"),
    )
    fields = F.str_to_map("metadata_block", F.lit("\r\n"), F.lit(": "))
    found = found.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return found.select(
        F.col("capture").alias("record_id"),
        F.struct(*wanted).alias("response"),
        F.when(F.col("request_id").isNotNull(), F.struct("request_id", "request_block")).alias("request"),
        F.when(F.col("metadata_id").isNotNull(), F.struct("metadata_id", fields.alias("fields"))).alias("metadata"),
    )


def captured_pages(found: DataFrame) -> DataFrame:
    """Page, payload size and digest, record type and the page referred to."""
    return found.select(
        F.col("metadata.fields")["page-id"].cast("bigint").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.col("metadata.fields")["refers-to-page"].cast("bigint").alias("refers_to"),
    )

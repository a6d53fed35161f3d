"""Web archives: one transaction of records per page, written as WARC files and assembled again.

A capture is a request, a response (or a revisit of an earlier response with the same payload) and a metadata
record. Request and metadata name the capture's main record in WARC-Concurrent-To; reading
joins the three through it. Files hold WARC/1.1 records back to back, plain as they are written here, or in gzip members.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eigenlake.llm.staging import Staging

# Payloads below this size are always stored.
LEAST_REVISIT = 100
# Bytes of one file, so that a file is small enough to be read whole by one task; only a single larger record exceeds them.
FILE_BYTES = 256 << 20
# Captures are written by classes of size, each this many times the one below; files of a class hold as many records as surely fit.
SIZE_STEP, LEAST_RECORDS = 8, 4096
# What a record holds besides payload and address, at most.
HEAD_BYTES = 2048
# No clock is read: runs agree.
DATE = "2024-01-01T00:00:00Z"

# Compressed bytes taken at once.
PIECE_BYTES = 1 << 16

LINE = "\r\n"
END = "\r\n\r\n"


def _urn(*parts: Column) -> Column:
    digest = F.md5(F.concat_ws("|", *parts))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(digest, a, n) for a, n in cuts]), F.lit(">"))


def _record(kind: Column, record_id: Column, headers: list[tuple[str, Column]], body: Column) -> Column:
    """A record without the blank lines that end it; a header without value is left out."""
    lines = [F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), record_id)]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string"))
    return F.concat(F.lit(f"WARC/1.1{LINE}"), F.concat_ws(LINE, *lines, length), F.lit(END), body)


def write_archives(pages: DataFrame, path: str, date: str = DATE) -> None:
    """Write ``pages(page_id, url, html, ...)`` to a new folder of archives.

    The payload is the html in UTF-8 (null: empty). Of rows with equal payloads of at least
    ``LEAST_REVISIT`` bytes that with the smallest page_id (null last) is stored, others revisit it. Rows that
    share page_id and payload are one capture made several times, and all stored if it is the first.
    No file is larger than ``FILE_BYTES`` unless a single record is.
    """
    staging = Staging(pages.sparkSession, "archives")
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload")})
    order = F.struct(F.col("page_id").isNull().alias("missing"), F.col("page_id"))
    # Only digests of several rows are kept: usually a small table, and one that a join can split at a hot key.
    first = rows.where(F.col("size") >= LEAST_REVISIT).groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("rows"))
    first = staging.keep(first.where("rows > 1").select("digest", F.col("first.page_id").alias("first_id")), "first")
    known = F.broadcast(first) if _small(first) else first
    rows = rows.join(known.withColumn("shared", F.lit(True)), "digest", "left")
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    origin = F.coalesce(F.col("first_id").cast("string"), F.lit("null"))
    again = F.coalesce(F.col("shared") & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.lit(False))
    main = _urn(F.lit("capture"), page, F.col("digest"))
    target = ("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7f]", "%20"))
    dated, sha = ("WARC-Date", F.lit(date)), F.concat(F.lit("sha256:"), F.col("digest"))
    fields = F.concat_ws(
        LINE,
        F.concat(F.lit("pageId: "), F.col("page_id").cast("string")),
        F.concat(F.lit("payloadLength: "), F.col("size").cast("string")),
        F.concat(F.lit("refersToPageId: "), F.when(again, F.col("first_id").cast("string"))),
    )
    request = F.concat(F.lit("GET "), target[1], F.lit(f" HTTP/1.1{END}"))
    response = F.when(again, F.lit(f"HTTP/1.1 200 OK{END}")).otherwise(
        F.concat(F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{END}"), F.col("payload"))
    )
    records = F.array(
        _record(
            F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
            main,
            [
                dated,
                target,
                ("WARC-Payload-Digest", sha),
                ("WARC-Refers-To", F.when(again, _urn(F.lit("capture"), origin, F.col("digest")))),
                ("WARC-Profile", F.when(again, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
                ("Content-Type", F.lit("application/http;msgtype=response")),
            ],
            response,
        ),
        _record(
            F.lit("request"),
            _urn(F.lit("request"), page, F.col("digest")),
            [dated, target, ("WARC-Concurrent-To", main), ("Content-Type", F.lit("application/http;msgtype=request"))],
            request,
        ),
        _record(
            F.lit("metadata"),
            _urn(F.lit("metadata"), page, F.col("digest")),
            [dated, target, ("WARC-Concurrent-To", main), ("Content-Type", F.lit("application/warc-fields"))],
            fields,
        ),
    )
    least = max(1, FILE_BYTES // LEAST_RECORDS)
    room = F.col("size") + 4 * F.octet_length(F.coalesce("url", F.lit(""))) + HEAD_BYTES
    grade = F.greatest(F.lit(0), F.ceil(F.log(float(SIZE_STEP), room / least))).cast("int")
    grades = [row[0] for row in rows.select(grade.alias("grade")).distinct().collect()]
    for number in sorted(grades) or [0]:
        fits = max(1, FILE_BYTES // (least * SIZE_STEP**number))
        chosen = rows.where(grade == number) if len(grades) > 1 else rows
        # The separator of the text writer is the end of a WARC record.
        writer = chosen.select(F.explode(records).alias("record")).write.mode("append").option("lineSep", END)
        writer.option("maxRecordsPerFile", fits).text(path)


def _small(frame: DataFrame, rows: int = 50_000) -> bool:
    """Whether a staged frame has few enough rows of fixed width to be sent to every task."""
    return frame.limit(rows + 1).count() <= rows


def inflated(data: memoryview) -> Iterator[bytes]:
    """The contents of the gzip members of an archive, a bounded piece at a time."""
    at = 0
    while at < len(data):
        member = zlib.decompressobj(wbits=31)
        while not member.eof and at < len(data):
            piece = bytes(data[at : at + PIECE_BYTES])
            yield member.decompress(piece)
            at += len(piece)
        at -= len(member.unused_data)
        if not member.eof:
            raise ValueError("an archive ends within a gzip member")


def records_in(data: memoryview) -> Iterator[tuple[dict[str, str], memoryview]]:
    """Headers and block of each record of an archive, plain or in gzip members; of the latter one record is held at a time."""
    if bytes(data[:2]) != b"\x1f\x8b":
        yield from parse_records(data)
        return
    held = bytearray()
    for piece in inflated(data):
        held += piece
        while (size := record_size(held)) is not None and size <= len(held):
            yield from parse_records(memoryview(bytes(held[:size])))
            del held[:size]
    if held.strip(b"\r\n"):
        yield from parse_records(memoryview(bytes(held)))


def record_size(held: bytearray) -> int | None:
    """Bytes of the record that ``held`` begins with, its end included; None before its headers are complete."""
    stop = held.find(b"\r\n\r\n")
    if stop < 0:
        return None
    for line in bytes(held[:stop]).split(b"\r\n"):
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length":
            return stop + 8 + int(value)
    raise ValueError("a record without Content-Length")


def parse_records(data: memoryview) -> Iterator[tuple[dict[str, str], memoryview]]:
    """Headers (names in lower case) and block of each record of an archive."""
    at = 0
    raw = bytes(data[:0])
    while at < len(data):
        stop, step = -1, 4096
        while stop < 0:
            raw = bytes(data[at : at + step])
            stop = raw.find(b"\r\n\r\n")
            if stop < 0 and at + step >= len(data):
                raise ValueError(f"no end of headers after byte {at}")
            step *= 2
        lines = raw[:stop].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
        start = at + stop + 4
        end = start + int(headers["content-length"])
        yield headers, data[start:end]
        at = end + 4


def head_end(block: memoryview) -> int:
    """Where the body of an HTTP message begins."""
    step = 4096
    while True:
        stop = bytes(block[:step]).find(b"\r\n\r\n")
        if stop >= 0:
            return stop + 4
        if step >= len(block):
            raise ValueError("no end of the HTTP headers in a block")
        step *= 2


RECORD = (
    "kind string, record_id string, capture string, uri string, refers_to string, digest string,"
    " fields map<string,string>, payload_digest string, payload_bytes long"
)


def read_records(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """One row per record; ``capture`` is the id of the main record it belongs to.

    ``payload_digest`` and ``payload_bytes`` are those of the bytes found; ``payload`` adds the bytes of responses.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows: list[list] = [[] for _ in range(10 if payload else 9)]
                for headers, block in records_in(memoryview(content.as_buffer())):
                    kind, body, fields = headers["warc-type"], None, None
                    if kind in ("response", "revisit"):
                        body = block[head_end(block) :]
                    elif kind == "metadata":
                        pairs = (line.partition(":") for line in bytes(block).decode().split("\r\n") if line)
                        fields = [(name.strip(), value.strip()) for name, _, value in pairs]
                    main = headers.get("warc-concurrent-to", headers["warc-record-id"])
                    values = [kind, headers["warc-record-id"], main, headers.get("warc-target-uri"), headers.get("warc-refers-to")]
                    values += [headers.get("warc-payload-digest"), fields]
                    values += [None if body is None else hashlib.sha256(body).hexdigest(), None if body is None else len(body)]
                    values += [bytes(body) if kind == "response" else None] if payload else []
                    for column, value in zip(rows, values, strict=True):
                        column.append(value)
                kinds = [pa.string()] * 6 + [pa.map_(pa.string(), pa.string()), pa.string(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(rows, kinds)],
                    names=[f.split()[0] for f in RECORD.split(", ")] + ["payload"] * payload,
                )

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, RECORD + (", payload binary" if payload else ""))


def read_transactions(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """One nested row per capture: ``capture, main, request, metadata``.

    Records meet through the concurrent-to identifiers; a record type that is missing is null,
    a capture without main record is left in with a null one. A capture stored several times has a row for each.
    """
    records = read_records(spark, path, payload)
    columns = [c for c in records.columns if c != "capture"]
    body = F.struct(*columns) if payload else F.struct(*[c for c in columns if c != "fields"], F.col("fields"))
    is_main = F.col("kind").isin("response", "revisit")
    keyed = records.select(
        "capture",
        is_main.alias("is_main"),
        F.when(is_main, body).alias("main"),
        F.when(F.col("kind") == "request", body).alias("request"),
        F.when(F.col("kind") == "metadata", body).alias("metadata"),
    )
    met = keyed.groupBy("capture").agg(
        F.greatest(F.count_if("is_main"), F.lit(1)).cast("int").alias("times"),
        *[F.first(name, ignorenulls=True).alias(name) for name in ("main", "request", "metadata")],
    )
    return met.select("capture", "main", "request", "metadata", F.explode(F.sequence(F.lit(1), "times")).alias("time")).drop("time")


def page_digests(pages: DataFrame, path: str) -> DataFrame:
    """Write ``pages`` as archives to ``path`` and read back ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    A revisit's size and digest are those of the full payload it refers to.
    """
    write_archives(pages, path)
    kind = dict(pages.dtypes)["page_id"]
    found = read_transactions(pages.sparkSession, path)
    field = F.col("metadata.fields")
    stored = F.col("main.kind") == "response"
    return found.select(
        field["pageId"].cast(kind).alias("page_id"),
        F.when(stored, F.col("main.payload_bytes")).otherwise(field["payloadLength"].cast("long")).alias("payload_bytes"),
        F.when(stored, F.col("main.payload_digest")).otherwise(F.substring_index("main.digest", ":", -1)).alias("payload_digest"),
        F.col("main.kind").alias("record_type"),
        field["refersToPageId"].cast(kind).alias("refers_to"),
    )

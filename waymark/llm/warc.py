"""WARC archives of captures: written and read by Spark, transactions joined into one nested row each.

Each capture is three records that name each other through WARC-Concurrent-To: the request, the response (or a revisit
of an equal earlier payload) and its metadata. ``write_archives`` builds a capture's records in JVM expressions and
lets Spark's text sink write them, so lost tasks leave no partial files; ``read_records`` reads whole archive files of
bounded size and walks them by Content-Length; ``captures`` joins the records of a transaction.

Equal payloads are found by digest. A digest that a third of all pages share is no hot key: the first capture of each
(digest, salt) is found first, then that of each digest, which is handed back to the digest's salts.

Defined results: a null html is an empty payload; a null url gives a record without target and reads back as null; a
null page id makes a record whose id is null, ordered after all others; repeated rows are captures of their own, and
among rows of one id the one read first is the response. Control characters and blanks in a url are percent-encoded.
An empty table gives an empty archive. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.tables import new_folder

CRLF = "\r\n"
SALTS = 64
MIN_REVISIT_BYTES = 100
#: Captures a file holds at most; a reader takes one file at a time.
CAPTURES_PER_FILE = 2000
#: A row for each record: its named fields, and for responses the payload.
RECORD = ("record_id string, concurrent_to string, record_type string, target string, refers_to string, "
          "page_id long, content_type string, payload binary, payload_bytes long, payload_digest string, "
          "digest_valid boolean")


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"),
                    F.substring(h, 13, 4), F.lit("-"), F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12),
                    F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing if the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def _record(kind: Column | str, record_id: Column, fields: list[Column], content_type: str, block: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.concat(F.lit(f"WARC/1.1{CRLF}"), _field("WARC-Type", kind), _field("WARC-Record-ID", record_id), *fields,
                    _field("Content-Type", F.lit(content_type)),
                    _field("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF), block)


def _safe(url: Column) -> Column:
    """The url without characters that would end a header line."""
    for char, code in (("\r", "%0D"), ("\n", "%0A"), (" ", "%20"), ("\t", "%09")):
        url = F.replace(url, F.lit(char), F.lit(code))
    return url


def with_revisits(pages: DataFrame, key: str = "page_id", html: str = "html", url: str = "url",
                  least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, capture, digest, n_bytes and first: the capture and page of the response it repeats."""
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{key}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                        payload.alias("payload"), F.monotonically_increasing_id().alias("__seq"))
    rows = rows.withColumns({
        "digest": F.sha2(F.col("payload").cast("binary"), 256), "n_bytes": F.octet_length("payload").cast("long"),
        "capture": _uuid(F.col("page_id").cast("string"), F.col("__seq").cast("string")),
        "salt": F.pmod(F.xxhash64("page_id", "__seq"), F.lit(SALTS)).cast("int"),
    })
    order = F.struct(F.col("page_id").isNull().alias("absent"), "page_id", "__seq", "capture")
    by_salt = rows.where(F.col("n_bytes") >= least).groupBy("digest", "salt").agg(
        F.min(order).alias("first"), F.count("*").alias("n"))
    firsts = by_salt.groupBy("digest").agg(F.min("first").alias("first"), F.sum("n").alias("n"),
                                           F.collect_list("salt").alias("salts"))  # at most SALTS of them
    firsts = firsts.where("n > 1").select("digest", F.explode("salts").alias("salt"), "first")
    return rows.join(firsts, ["digest", "salt"], "left")


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", html: str = "html", url: str = "url",
                   least: int = MIN_REVISIT_BYTES, date: str = "2024-01-01T00:00:00Z") -> None:
    """One request, response or revisit, and metadata record per page, in gzipped WARC files under ``folder``."""
    rows = with_revisits(pages, key, html, url, least)
    revisit = F.col("first").isNotNull() & (F.col("first.capture") != F.col("capture"))
    target, page = _safe(F.col("url")), F.col("page_id").cast("string")
    when = _field("WARC-Date", F.lit(date))
    about = [_field("WARC-Target-URI", target), when]
    main = F.col("capture")
    host = F.regexp_extract(F.coalesce(target, F.lit("")), r"^[a-z]+://([^/?#]*)", 1)
    path = F.regexp_extract(F.coalesce(target, F.lit("")), r"^[a-z]+://[^/?#]*(/[^#]*)", 1)
    request = F.concat(F.lit("GET "), F.when(path == "", "/").otherwise(path), F.lit(f" HTTP/1.1{CRLF}Host: "), host,
                       F.lit(CRLF + CRLF))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("n_bytes").cast("string"), F.lit(CRLF + CRLF))
    concurrent = _field("WARC-Concurrent-To", main)
    records = [
        _record("request", _uuid(main, F.lit("request")), [*about, concurrent], "application/http; msgtype=request",
                request),
        _record(F.when(revisit, "revisit").otherwise("response"), main, [
            *about, _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
            F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                                  + CRLF)).otherwise(""),
            _field("WARC-Refers-To", F.when(revisit, F.col("first.capture")))],
            "application/http; msgtype=response",
            F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))),
        _record("metadata", _uuid(main, F.lit("metadata")), [*about, concurrent], "application/warc-fields",
                F.concat(_field("pageId", page), _field("payloadBytes", F.col("n_bytes").cast("string")),
                         _field("repeatsPage", F.when(revisit, F.col("first.page_id").cast("string"))))),
    ]
    rows.select(F.concat_ws(CRLF + CRLF, *records).alias("value")).write.option("compression", "gzip") \
        .option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", CAPTURES_PER_FILE).text(folder)


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], memoryview]]:
    """Header fields and block of each record of an archive, by its Content-Length; raises on a damaged record."""
    view, at, size = memoryview(data), 0, len(data)
    while at < size:
        end = data.find(b"\r\n\r\n", at)
        lines = bytes(view[at:end]).decode("utf-8", "replace").split(CRLF) if end >= 0 else [""]
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
        begin = end + 4
        at = begin + int(fields["content-length"])
        if at > size:
            raise ValueError(f"a record at byte {begin} is cut")
        yield fields, view[begin:at]
        at += 4


def _row(fields: dict[str, str], block: memoryview) -> tuple:
    kind = fields["warc-type"]
    page = count = refers = payload = digest = valid = None
    if kind == "metadata":
        own = dict(line.split(": ", 1) for line in bytes(block).decode().split(CRLF) if line)
        page, count, refers = (int(own[k]) if k in own else None for k in ("pageId", "payloadBytes", "repeatsPage"))
        refers = None if refers is None else str(refers)
    elif kind in ("response", "revisit"):
        digest = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
        refers = fields.get("warc-refers-to")
        if kind == "response":
            whole = bytes(block)
            payload = whole[whole.find(b"\r\n\r\n") + 4:]
            found, count = hashlib.sha256(payload).hexdigest(), len(payload)
            valid, digest = digest is None or found == digest, found
    return (fields["warc-record-id"], fields.get("warc-concurrent-to"), kind, fields.get("warc-target-uri"), refers,
            page, fields.get("content-type"), payload, count, digest, valid)


_TYPES = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]
_NAMES = [f.split(" ")[0] for f in RECORD.split(", ")]


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zlib

    for batch in batches:
        for value in batch.column(0):
            data = value.as_buffer().to_pybytes()
            if data[:2] == b"\x1f\x8b":
                parts = []
                while data:  # an archive may be one gzip member, or one a record
                    member = zlib.decompressobj(31)
                    parts.append(member.decompress(data))
                    data = member.unused_data
                data = b"".join(parts)
            rows, held = [], 0
            for fields, block in parsed(data):
                rows.append(_row(fields, block))
                held += len(block)
                if held > 4_000_000:
                    yield _batch(rows)
                    rows, held = [], 0
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives under ``folder``; see RECORD."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").schema(
        "path string, modificationTime timestamp, length long, content binary").load(folder)
    return files.select("content").mapInArrow(_read_batches, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture, response (or revisit), request and metadata.

    A request or metadata record belongs to the record it is concurrent to; a missing one is null. A transaction has
    one record of each kind, so record ids are as many as captures and no key is hot.
    """
    main = records.where("record_type IN ('response', 'revisit')").select(
        F.col("record_id").alias("capture"),
        F.struct("record_type", "target", "refers_to", "payload", "payload_bytes", "payload_digest",
                 "digest_valid").alias("response"))
    request = records.where("record_type = 'request'").select(
        F.col("concurrent_to").alias("capture"), F.struct("record_id", "target", "content_type").alias("request"))
    metadata = records.where("record_type = 'metadata'").select(
        F.col("concurrent_to").alias("capture"),
        F.struct("record_id", "page_id", "payload_bytes", F.col("refers_to").cast("long").alias("repeats_page"))
        .alias("metadata"))
    return main.join(request, "capture", "left").join(metadata, "capture", "left")


def round_trip(pages: DataFrame, key: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """The pages' captures, written to new archives in the shared folder and read back."""
    folder = new_folder(pages.sparkSession, "warc")
    write_archives(pages, folder, key, html, url)
    return captures(read_records(pages.sparkSession, folder))

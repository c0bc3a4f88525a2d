"""WARC archives: writing, reading, and assembly of transactions into one nested row per capture.

Writing goes through Spark's text writer (a record is text whose lines end in CR LF), so archives land in
any file system that Spark reaches, optionally gzipped. Every capture gets a request record, a response
or revisit record and a metadata record; request and metadata name the response in WARC-Concurrent-To.
Reading splits whole archive files by Content-Length, so a file must fit in a worker: ``archive`` writes large
payloads to files of fewer records, and none has more than ``FILE_BYTES`` of payloads or a single record's.

Assembly gathers records by the identifier that they are concurrent to and emits one row per capture with
nested request, response and metadata. Equal payloads are found by digest with a partially aggregated
minimum and joined back, so a payload that a third of all pages share is no task of its own.

Defined results: a null payload is an empty one; a null URL leaves WARC-Target-URI out; CR and LF in URLs are
percent-encoded. A capture's id follows from page id, URL and payload, so rows of one page id that differ are
captures of their own; equal rows write records with equal ids, and each comes out as a row whose request and
metadata are shared. All rows of the smallest page id with a payload are responses. A null page id is larger than
any other, has no page-id field, and comes back as null. Records that are concurrent to nothing known
come out as rows without a response. Other columns of the pages are left alone: only the three are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import let

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "record_id string, type string, concurrent_to string, refers_to string, uri string, digest string, payload binary, payload_bytes long, payload_digest string, fields map<string,string>"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Most bytes of payloads in an archive file, and most records.
FILE_BYTES, FILE_RECORDS = 64 << 20, 3_000


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 160 bits are exactly 32 digits of 5 bits, 4 to a 20-bit group."""

    def digits(hexed: Column) -> Column:
        out = []
        for at in range(0, 40, 5):
            group = F.conv(F.substring(hexed, at + 1, 5), 16, 10).cast("int")
            out += [F.substring(F.lit(_ALPHABET), F.shiftright(group, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
        return F.concat(*out)

    return let(F.sha1(payload), digits)


def record_id(kind: str, *key: Column) -> Column:
    """A name-based UUID URN, the same in every run."""
    h = F.md5(F.concat_ws("\n", F.lit(kind), *[F.coalesce(k.cast("string"), F.lit("\r")) for k in key]))
    cut = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("3"), F.substring(h, 14, 3)), F.concat(F.lit("8"), F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """The text of a record without its last CR LF, which the text writer adds."""
    lines = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v, F.lit(CRLF))) for k, v in headers]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF))
    return F.concat(F.lit("WARC/1.1" + CRLF), *[F.coalesce(x, F.lit("")) for x in lines], length, F.lit(CRLF), block, F.lit(CRLF))


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0, over_bytes: int = -1, most_bytes: int | None = None) -> DataFrame:
    """The records to write, one text each in column ``value``: request, response or revisit, metadata.

    ``over_bytes``, ``most_bytes``: only records of pages with payloads in these bounds; all count as firsts.
    """
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit(""))
    uri = F.replace(F.replace(F.col(f"`{url}`"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    own = pages.select(F.col(f"`{page_id}`").alias("id"), uri.alias("uri"), body.alias("body")).withColumn("digest", base32_sha1(F.col("body").cast("binary"))).withColumn("bytes", F.octet_length("body"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", F.col("uri").isNull().alias("no_uri"), "uri")
    first = own.where(F.col("bytes") >= least_bytes).groupBy(F.col("digest").alias("_digest"), F.col("bytes").alias("_bytes")).agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    marked = own.join(first, (F.col("digest") == F.col("_digest")) & (F.col("bytes") == F.col("_bytes")), "left")
    if most_bytes is not None:
        marked = marked.where((F.col("bytes") > over_bytes) & (F.col("bytes") <= most_bytes))
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first.id"))
    key = [F.col("id"), F.col("uri"), F.col("digest"), F.col("bytes")]
    response = record_id("response", *key)
    host = F.regexp_extract(F.coalesce("uri", F.lit("")), "^[a-z]+://([^/?#]*)", 1)
    path = F.regexp_extract(F.coalesce("uri", F.lit("")), "^[a-z]+://[^/?#]*(.*)$", 1)
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF + CRLF))
    ask = F.concat(F.lit("GET "), F.when(path == "", F.lit("/")).otherwise(path), F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(CRLF + CRLF))
    about = F.concat(F.coalesce(F.concat(F.lit("page-id: "), F.col("id").cast("string"), F.lit(CRLF)), F.lit("")), F.lit("payload-bytes: "), F.col("bytes").cast("string"), F.lit(CRLF))
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    common = [("WARC-Date", F.lit(DATE)), ("WARC-Target-URI", F.col("uri"))]
    request = _record([("WARC-Type", F.lit("request")), ("WARC-Record-ID", record_id("request", *key)), *common, ("WARC-Concurrent-To", response), ("Content-Type", F.lit("application/http; msgtype=request"))], ask)
    answer = _record(
        [
            ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
            ("WARC-Record-ID", response),
            *common,
            ("WARC-Payload-Digest", digest),
            ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
            ("WARC-Refers-To", F.when(revisit, record_id("response", F.col("first.id"), F.col("first.uri"), *key[2:]))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.when(revisit, http).otherwise(F.concat(http, F.col("body"))),
    )
    meta = _record([("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", record_id("metadata", *key)), *common, ("WARC-Concurrent-To", response), ("Content-Type", F.lit("application/warc-fields"))], about)
    return marked.select(F.explode(F.array(request, answer, meta)).alias("value"))


def write(texts: DataFrame, path: str, records_per_file: int = FILE_RECORDS, compression: str = "gzip") -> None:
    """Write records (``records``) as archive files below ``path``."""
    texts.write.mode("append").option("lineSep", CRLF).option("maxRecordsPerFile", records_per_file).option("compression", compression).text(path)


def archive(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0, file_bytes: int = FILE_BYTES, file_records: int = FILE_RECORDS, compression: str = "gzip") -> None:
    """Write the records of ``pages`` below ``path``, payloads up to ``file_bytes / file_records`` bytes first, then
    those up to 16 times as many with a 16th of the records to a file, and so on up to the largest payload."""
    largest = pages.agg(F.max(F.octet_length(F.col(f"`{payload}`").cast("string")))).first()[0] or 0
    over, most, per = -1, file_bytes // file_records, file_records
    while True:
        last = per == 1 or largest <= most
        write(records(pages, page_id, url, payload, least_bytes, over, None if over < 0 and last else largest if last else most), path, per, compression)
        if last:
            return
        over, most, per = most, most * 16, max(1, per // 16)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record of an archive."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start = end + 4
        stop = start + int(headers["content-length"])
        yield headers, data[start:stop]
        at = stop
        while data[at : at + 2] == b"\r\n":
            at += 2


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the archives below ``path``, with schema ``RECORD``.

    Size and digest of a payload are worked out from its bytes as they are read; without ``payloads`` the
    bytes themselves go no further, so that assembly shuffles identifiers and digests only.
    """
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                rows: list[tuple] = []
                for h, block in parse(value.as_py()):
                    kind, fields, payload = h["warc-type"], {}, None
                    if kind in ("response", "revisit"):
                        payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                    elif kind == "metadata":
                        fields = {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in block.decode("utf-8").split(CRLF) if x)}
                    digest = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    size, own = (None, None) if payload is None else (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
                    rows.append((h["warc-record-id"], kind, h.get("warc-concurrent-to"), h.get("warc-refers-to"), h.get("warc-target-uri"), digest, payload if payloads else None, size, own, list(fields.items())))
                    if len(rows) == 2000:
                        yield _batch(rows)
                        rows = []
                yield _batch(rows)

    return files.mapInArrow(run, RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 6 + [pa.binary(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string())]
    names = ["record_id", "type", "concurrent_to", "refers_to", "uri", "digest", "payload", "payload_bytes", "payload_digest", "fields"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def assemble(found: DataFrame) -> DataFrame:
    """One row per capture: capture_id and nested ``response`` (response or revisit), ``request``, ``metadata``.

    Of several requests or metadata records of one capture the one with the smallest id is taken, and
    ``n_records`` counts them all. Maxima and minima aggregate partially, so many records that name one
    capture are reduced before they meet.
    """
    named = found.withColumn("capture_id", F.coalesce("concurrent_to", "record_id"))

    def pick(test: Column, *fields: str) -> Column:
        return F.min(F.when(test, F.struct("record_id", *fields)))

    kind = F.col("type")
    answered = named.where(kind.isin("response", "revisit")).select("capture_id", F.struct("record_id", "type", "refers_to", "uri", "digest", "payload", "payload_bytes", "payload_digest").alias("response"))
    rest = named.where(~kind.isin("response", "revisit")).withColumn("entries", F.array_sort(F.map_entries("fields")))
    rest = rest.groupBy("capture_id").agg(pick(kind == "request", "uri").alias("request"), pick(kind == "metadata", "entries").alias("metadata"), F.count("*").alias("n"))
    both = answered.join(rest, "capture_id", "full")
    meta = F.when(F.col("metadata").isNotNull(), F.struct(F.col("metadata.record_id").alias("record_id"), F.map_from_entries("metadata.entries").alias("fields")))
    return both.select("capture_id", "request", "response", meta.alias("metadata"), (F.coalesce("n", F.lit(0)) + F.col("response").isNotNull().cast("int")).alias("n_records"))


def payload_facts(captures: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of assembled captures.

    Bytes and digest of a response are those of the payload that was read; a revisit has those of the
    response that it refers to.
    """
    page = F.col("metadata.fields")["page-id"].try_cast("long")
    own = captures.where("response IS NOT NULL").select("capture_id", page.alias("page_id"), F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("_to"), F.col("response.payload_bytes").alias("_bytes"), F.col("response.payload_digest").alias("_digest"))
    targets = own.where("record_type = 'response'").groupBy(F.col("capture_id").alias("_id")).agg(F.min("page_id").alias("refers_to"), F.min("_bytes").alias("_b"), F.min("_digest").alias("_d"))
    joined = own.join(targets, F.col("_to") == F.col("_id"), "left")
    return joined.select("page_id", F.coalesce("_bytes", "_b").alias("payload_bytes"), F.coalesce("_digest", "_d").alias("payload_digest"), "record_type", "refers_to")


def name_of(kind: str, *key: object) -> str:
    """What ``record_id`` makes, in Python."""
    h = hashlib.md5("\n".join([kind, *["\r" if k is None else str(k) for k in key]]).encode()).hexdigest()
    return f"<urn:uuid:{uuid.UUID(h[:12] + '3' + h[13:16] + '8' + h[17:])}>"

"""WARC archives: written with segmented, chunked and revisit records, and read back whole.

Writing: a payload becomes the body of an HTTP response in chunked framing. A block longer than ``segment_bytes`` is cut into a
first segment and continuation records. Of records with equal payloads of at least ``revisit_bytes``, one is a response and
the others are revisits without a body.

Reading: files are cut into records by their lengths; segments are grouped by the identifier of the first one, put in
order, checked for gaps and against the total length, and joined; then the HTTP header is taken off and the chunked
framing decoded. Only segmented records are shuffled.

Files are written by Spark's text writer (a record's end is its line separator) and read by its binary reader, so they
may lie in any store Spark reaches. Each file is one gzip stream. It is read by one task: ``file_records`` and
``segment_bytes`` bound its size.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator
from hashlib import md5

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm.common import map_texts, quoted
from carelens.session import materialise, scratch_path

SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
FILE_RECORDS = 4096
REVISIT_BYTES = 100

#: Fixed values of the format.
VERSION = b"WARC/1.1"
LINE = b"\r\n"
END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEADER = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def to_chunks(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def from_chunks(body: bytes) -> bytes | None:
    """The payload of a chunked body, whatever follows the last chunk; None if the framing is broken."""
    parts, at = [], 0
    while True:
        line = body.find(LINE, at)
        try:
            size = int(body[at:line].split(b";")[0], 16) if line >= 0 else -1
        except ValueError:
            return None
        if size < 0:
            return None
        if not size:
            return b"".join(parts)
        at = line + 2 + size
        if body[at : at + 2] != LINE:
            return None
        parts.append(body[line + 2 : at])
        at += 2


def http_payload(block: bytes) -> bytes | None:
    """The body of an HTTP response, its transfer framing undone; None if it is broken."""
    head, blank, body = block.partition(END)
    if not blank:
        return None
    fields = header_fields(head)
    if "chunked" in fields.get("transfer-encoding", "").lower():
        return from_chunks(body)
    length = fields.get("content-length")
    if length is None:
        return body
    return body[: int(length)] if length.isdigit() and len(body) >= int(length) else None


def header_fields(head: bytes) -> dict[str, str]:
    """Fields by lower-case name, without the first line."""
    out = {}
    for line in head.split(LINE)[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            out[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return out


def _record(kind: str, record_id: str, fields: dict[str, object], block: bytes) -> bytes:
    lines = [VERSION, b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: " + record_id.encode(), b"WARC-Date: 1970-01-01T00:00:00Z"]
    lines += [f"{k}: {v}".encode("utf-8", "replace") for k, v in fields.items() if v is not None]
    lines.append(b"Content-Length: %d" % len(block))
    return LINE.join(lines) + END + block


def record_id(page_id: object, url: object, digest: str) -> str:
    """The same for rows that are equal, so that a task that runs again writes the same."""
    h = md5(repr((page_id, url, digest)).encode("utf-8", "replace")).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def records(page_id, url, payload: bytes, digest: str, first_id, first_url, segment_bytes: int) -> Iterator[bytes]:
    """The records of one page; a revisit if ``first_id`` is given. Spaces and control characters in an address are escaped."""
    name = record_id(page_id, url, digest)
    fields = {
        "WARC-Target-URI": None if url is None else _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url),
        "X-Page-ID": page_id,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "application/http;msgtype=response",
    }
    if first_id is not None:
        yield _record("revisit", name, {**fields, "WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_id(first_id, first_url, digest)}, b"")
        return
    block = HTTP_HEADER + to_chunks(payload)
    if len(block) <= segment_bytes:
        yield _record("response", name, fields, block)
        return
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    yield _record("response", name, {**fields, "WARC-Segment-Number": 1}, parts[0])
    for n, part in enumerate(parts[1:], 2):
        more = {"WARC-Segment-Origin-ID": name, "WARC-Segment-Number": n}
        if n == len(parts):
            more["WARC-Segment-Total-Length"] = len(block)
        yield _record("continuation", record_id(name, n, digest), more, part)


def write(pages: DataFrame, path: str, revisit_bytes: int = REVISIT_BYTES, segment_bytes: int = SEGMENT_BYTES, file_records: int = FILE_RECORDS) -> None:
    """Write (page_id, url, payload binary) as WARC files under ``path``.

    Null payloads are empty. Of equal payloads of at least ``revisit_bytes`` the smallest page_id is the response (all rows of
    that id and payload are); the others, rows without id included, are revisits. If none of them has an id, all are responses.
    Which payloads repeat is found by counts that are combined before the shuffle; large partitions of the join are split.
    """
    rows = pages.select("page_id", "url", F.coalesce("payload", F.lit(b"")).alias("payload")).withColumn("digest", F.sha2("payload", 256))
    large = rows.filter(F.octet_length("payload") >= revisit_bytes)
    first = large.groupBy("digest").agg(F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "url")).alias("first"), F.count(F.lit(1)).alias("n"))
    first = first.filter("n > 1 AND first.page_id IS NOT NULL").select(
        F.col("digest").alias("first_digest"), F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url")
    )
    joined = rows.join(first.hint("shuffle_hash"), (F.col("digest") == F.col("first_digest")) & (F.octet_length("payload") >= revisit_bytes), "left")
    other = ~F.col("page_id").eqNullSafe(F.col("first_id"))
    ready = joined.select("page_id", "url", "payload", "digest", F.when(other, F.col("first_id")).alias("first_id"), "first_url")

    def run(batches):
        for batch in batches:
            out, size = [], 0
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                made = list(records(*row, segment_bytes))
                out += made
                size += sum(map(len, made))
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    lines = ready.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    writer = lines.write.option("lineSep", END.decode()).option("maxRecordsPerFile", file_records)
    writer.option("compression", "gzip").text(path)


def split_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes, bool]]:
    """Fields, block and completeness of each record of a file; a file that is gzip-compressed is opened first.

    Anything between records that is not a version line is skipped up to the next one.
    """
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    at = content.find(b"WARC/")
    while at >= 0:
        stop = content.find(END, at)
        if stop < 0:
            return
        fields = header_fields(content[at:stop])
        length = fields.get("content-length", "")
        size = int(length) if length.isdigit() else 0
        begin = stop + len(END)
        block = content[begin : begin + size]
        yield fields, block, length.isdigit() and len(block) == size
        at = content.find(b"WARC/", begin + size)


_RAW = "record_id string, kind string, origin string, segment int, total long, url string, page_id string, digest string, refers_to string, whole boolean, block binary"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record as it stands in the files."""

    def number(text):
        return int(text) if text is not None and text.isdigit() else None

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for f, block, whole in split_records(content.as_py()):
                    rows.append((
                        f.get("warc-record-id"), f.get("warc-type"), f.get("warc-segment-origin-id"), number(f.get("warc-segment-number")),
                        number(f.get("warc-segment-total-length")), f.get("warc-target-uri"), f.get("x-page-id"), f.get("warc-payload-digest"),
                        f.get("warc-refers-to"), whole, block,
                    ))
                    size += len(block)
                    if size > 8 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    names = [f.split()[0] for f in _RAW.split(", ")]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), *[pa.string()] * 4, pa.bool_(), pa.binary()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "[!._]*").load(path)
    return files.select("content").mapInArrow(run, _RAW)


def reassembled(found: DataFrame) -> DataFrame:
    """Records with continuations joined to their first segment: the same columns, ``whole`` only if nothing is missing.

    Numbers must run from 1 without a gap, the last segment must state the total length, and the block must have it. Segments written
    several times count once; the record comes out as often as its first segment does. Continuations without a first segment are
    left out. A group holds one record's segments, never more.
    """
    alone = found.filter("segment IS NULL")
    parts = found.filter("segment IS NOT NULL").withColumn("key", F.coalesce("origin", "record_id"))
    head = F.when(F.col("segment") == 1, F.struct("record_id", "kind", "url", "page_id", "digest", "refers_to"))
    grouped = parts.groupBy("key").agg(
        F.sort_array(F.collect_set(F.struct("segment", F.col("block").cast("string").alias("block")))).alias("parts"),
        F.max("total").alias("total"), F.min("whole").alias("whole"), F.max(head).alias("head"),
        F.count_if(F.col("segment") == 1).cast("int").alias("copies"),
    ).filter("copies > 0")
    block = F.array_join(F.transform("parts", lambda p: p["block"]), "").cast("binary")
    numbered = F.transform("parts", lambda p: p["segment"]) == F.sequence(F.lit(1), F.size("parts"))
    joined = grouped.select(
        "head.*", block.alias("block"), "total", (F.col("whole") & numbered).alias("whole"), F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("copy")
    )
    columns = ["record_id", "kind", "url", "page_id", "digest", "refers_to", "whole", "block"]
    checked = joined.withColumn("whole", F.col("whole") & F.coalesce(F.octet_length("block") == F.col("total"), F.lit(False)))
    return alone.select(*columns).union(checked.select(*columns))


def read(spark: SparkSession, path: str) -> DataFrame:
    """Responses and revisits: record_id, kind, url, page_id (string), digest, refers_to, payload, whole.

    ``payload`` is null for revisits and for records whose segments, length or framing are broken (``whole`` is false then).
    """
    rows = reassembled(read_records(spark, path)).filter(F.col("kind").isin("response", "revisit"))
    keep = ("record_id", "kind", "url", "page_id", "digest", "refers_to", "whole")

    def run(blocks):
        return {"payload": [None if b is None else http_payload(b) for b in blocks]}

    opened = map_texts(rows.withColumn("block", F.when((F.col("kind") == "response") & F.col("whole"), F.col("block"))), run, "payload binary", keep, "block")
    broken = (F.col("kind") == "response") & F.col("payload").isNull()
    return opened.withColumn("whole", F.col("whole") & ~broken)


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", **options) -> DataFrame:
    """Write every row to archives in the shared folder, read them, and tell what they hold.

    Per row: page_id, payload_bytes, payload_digest, record_type, refers_to (page_id of the response that a revisit refers to). A
    revisit's payload is that of its response. Null html is empty. Equal rows give equal records, all of which come back; null
    ids come back as null. An empty table gives no rows. Payloads that do not match the digest in their header fail the job.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write(pages.select(quoted(page_id).alias("page_id"), quoted(url).alias("url"), quoted(html).cast("binary").alias("payload")), path, **options)
    got = read(spark, path)
    own = F.sha2("payload", 256)
    right = F.col("whole") & ((F.col("kind") == "revisit") | (F.concat(F.lit("sha256:"), own) == F.col("digest")))
    checked = got.select(
        "record_id", "kind", F.col("page_id").cast("long").alias("page_id"), "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(right, F.coalesce(own, F.regexp_replace("digest", "^sha256:", ""))).otherwise(F.raise_error(F.lit("a record does not match its digest"))).alias("payload_digest"),
    )
    slim = materialise(checked, "records")
    responses = slim.filter("kind = 'response'").select(F.col("record_id").alias("to"), F.col("page_id").alias("to_page"), F.col("payload_bytes").alias("to_bytes")).distinct()
    joined = slim.join(responses, slim["refers_to"] == responses["to"], "left")
    return joined.select(
        "page_id", F.coalesce("payload_bytes", "to_bytes").alias("payload_bytes"), "payload_digest", F.col("kind").alias("record_type"), F.col("to_page").alias("refers_to")
    )

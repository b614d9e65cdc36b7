"""WARC archives: writing with segmented, chunked records, and reading them back.

A payload is framed by chunked transfer encoding; a record whose block is longer than ``SEGMENT`` bytes
is cut into segments, the first a response and the others continuations that name it, and the last tells
the total length. Readers group the segments by the record they continue, order them by number, verify
the total length and undo the chunks. Records of equal payloads point to one of them (revisits), which
carry the payload's headers but not the payload.

A record ends with two line ends, which is the line separator that Spark's text sink is given; so archives are
written and read by Spark alone, on whatever file system the paths are.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.llm.common import slices, text_of

#: Bytes of a record's block from which it is segmented, and of a chunk.
SEGMENT, CHUNK = 32 * 1024, 8 * 1024
#: Payloads from so many bytes on are stored once.
SHARED_LEAST = 1000
#: Records in one file, so that a file fits a task.
FILE_RECORDS = 2000
_LINE = b"\r\n"


def framed(payload: bytes, chunk: int = CHUNK) -> bytes:
    """Chunked transfer framing."""
    parts = [b"%x\r\n%s\r\n" % (len(payload[i:i + chunk]), payload[i:i + chunk]) for i in range(0, len(payload), chunk)]
    return b"".join(parts) + b"0\r\n\r\n"


def unframed(body: bytes) -> bytes | None:
    """The payload, or None where the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(_LINE, at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0:
            return None
        at = end + 2
        if not size:
            return b"".join(out)
        if body[at + size:at + size + 2] != _LINE:
            return None
        out.append(body[at:at + size])
        at += size + 2


def record(headers: dict[str, str], block: bytes) -> bytes:
    """One record without the two line ends after it."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block


def records_of(page: str, name: str, url: str, payload: bytes, refers_to: str | None) -> Iterator[bytes]:
    """The records of one page: a revisit, a response, or a response and its continuations."""
    digest = hashlib.sha1(payload).hexdigest()
    common = {"WARC-Target-URI": url, "WARC-Date": "1970-01-01T00:00:00Z", "WARC-Page": page, "WARC-Payload-Digest": digest}
    rid = f"<urn:page:{name}>"
    if refers_to is not None:
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        yield record({"WARC-Type": "revisit", "WARC-Record-ID": rid, **common, "WARC-Refers-To-Page": refers_to,
                      "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                      "Content-Type": "application/http; msgtype=response"}, head)
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + framed(payload)
    parts = [block[i:i + SEGMENT] for i in range(0, len(block), SEGMENT)]
    for n, part in enumerate(parts, 1):
        headers = {"WARC-Type": "response" if n == 1 else "continuation", "WARC-Record-ID": rid if n == 1 else f"<urn:page:{name}:{n}>", **common}
        if len(parts) > 1:
            headers["WARC-Segment-Number"] = str(n)
            if n > 1:
                headers["WARC-Segment-Origin-ID"] = rid
            if n == len(parts):
                headers["WARC-Segment-Total-Length"] = str(len(block))
        headers["Content-Type"] = "application/http; msgtype=response"
        yield record(headers, part)


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        for part in slices(batch, 64):
            out: list[bytes] = []
            for page, url, html, refers_to in zip(*(c.to_pylist() for c in part.columns), strict=True):
                name = "" if page is None else str(page)
                plain = " ".join((url or "").split())
                out += records_of(name, f"{name}:{task}:{n}", plain, (html or "").encode(), None if refers_to is None else str(refers_to))
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])


def write_archives(pages: DataFrame, path: str, shared_least: int = SHARED_LEAST) -> None:
    """Write ``pages`` (page_id, url, html; other columns are not read) as compressed archives below ``path``.

    Of pages with equal payloads of ``shared_least`` bytes or more, the one with the largest page_id is a
    response, and so are rows that repeat this id; the others refer to it. A null html is empty, a null url
    too, and a page without an id is never referred to. An empty table gives archives without records.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    payload = F.encode("html", "UTF-8")
    pages = pages.withColumn("_digest", F.when(F.octet_length("html") >= shared_least, F.sha1(payload)))
    shared = (pages.filter("_digest is not null").groupBy("_digest").agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .filter("_n > 1").drop("_n").withColumnRenamed("_digest", "_shared"))
    joined = pages.join(shared, F.col("_digest") == F.col("_shared"), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    records = joined.select("page_id", "url", "html", refers.alias("refers_to")).mapInArrow(_write, "record binary")
    (records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_RECORDS).text(path))


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an archive."""
    at = 0
    while (at := data.find(b"WARC/1.", at)) >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(headers.get("content-length", "0"))
        yield headers, data[end + 4:end + 4 + size]
        at = end + 4 + size


_RECORD = "type string, page string, digest string, refers_to string, origin string, segment int, total long, block binary"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _RECORD.split(", ")]
    types = [pa.string()] * 5 + [pa.int32(), pa.int64(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    for batch in batches:
        for i in range(batch.num_rows):
            rows, size = [], 0
            for h, block in parsed(zlib.decompress(batch.column(0)[i].as_py(), 47)):
                segment = h.get("warc-segment-number")
                origin = h.get("warc-segment-origin-id", h.get("warc-record-id")) if segment else None
                total = h.get("warc-segment-total-length")
                rows.append((h.get("warc-type"), h.get("warc-page"), h.get("warc-payload-digest"), h.get("warc-refers-to-page"), origin,
                             int(segment) if segment else None, int(total) if total else None, block))
                size += len(block)
                if size > 8 << 20:
                    yield batch_of(rows)
                    rows, size = [], 0
            yield batch_of(rows)


def put_together(found: DataFrame) -> DataFrame:
    """(type, page, digest, refers_to, block) of every whole record among ``found``, records and segments.

    Segments are grouped by the id of the record they continue. Where numbers are missing or double or the
    total length is not that of the parts, the block is null.
    """
    plain = ["type", "page", "digest", "refers_to", "block"]
    alone = found.filter("segment is null").select(*plain)
    parts = (found.filter("segment is not null").groupBy("origin")
             .agg(F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"), F.max("total").alias("total"),
                  *[F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in ("type", "page", "digest", "refers_to")]))
    block = F.aggregate("parts", F.unhex(F.lit("")), lambda acc, p: F.concat(acc, p["block"]))
    in_order = F.transform("parts", lambda p: p["segment"]) == F.sequence(F.lit(1), F.size("parts"))
    whole = parts.withColumn("block", block).withColumn("block", F.when(in_order & (F.octet_length("block") == F.col("total")), F.col("block")))
    return alone.unionByName(whole.select(*plain))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(type, page, digest, refers_to, block) of every whole record of the archives below ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return put_together(files.mapInArrow(_read, _RECORD))


_PAGE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 64):
            rows = []
            for kind, page, digest, refers_to, block in zip(*(c.to_pylist() for c in part.columns), strict=True):
                head, _, body = (block or b"").partition(b"\r\n\r\n")
                fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(_LINE)[1:])}
                if kind == "revisit":
                    size = int(fields.get(b"content-length", b"0"))
                else:
                    payload = unframed(body) if fields.get(b"transfer-encoding") == b"chunked" else body
                    broken = block is None or payload is None
                    size, digest = (None, None) if broken else (len(payload), hashlib.sha1(payload).hexdigest())
                rows.append((int(page) if page else None, size, digest, kind, int(refers_to) if refers_to else None))
            columns = zip(*rows) if rows else [[]] * 5
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [x.split()[0] for x in _PAGE.split(", ")])


def pages_of(records: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Size and digest of a response are those of its decoded payload, null where its segments or chunks are
    broken; a revisit's are those its headers give.
    """
    return records.select("type", "page", "digest", "refers_to", "block").mapInArrow(_decode, _PAGE)

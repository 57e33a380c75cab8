"""WARC archives: writing with revisit and segmented records, and reading back
with reassembly.

Writing: a page is an HTTP response with chunked transfer framing. Of pages
with equal payloads (of ``min_bytes`` or more) that with the largest id is the
response, the others are revisit records that refer to it. A block longer than
``SEGMENT`` bytes is cut into a first record and continuation records. Tasks
write archives of about ``ARCHIVE`` bytes to the cluster's shared folder with
Spark's own writer.

Reading: archives are parsed record by record by their Content-Length.
Segments are grouped by the id of the record they continue, ordered by segment
number, and the numbers and the total length are verified; then the transfer
framing is decoded and the payload digest verified. Only segmented records are
shuffled, and a group is one page.

Defined results: a null html is an empty payload; rows with equal id and payload
are all responses (or all revisits); a null id is a revisit if its payload has
a response with an id, else a response; an empty table gives no archives and no
rows. A damaged record raises ValueError, it is never dropped.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaymart.llm.common import written
from relaymart.session import work_path

SEGMENT = 64 * 1024
CHUNK = 8 * 1024
ARCHIVE = 16 * 1024 * 1024
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
         b"Transfer-Encoding: chunked\r\n\r\n")
_END = b"\r\n\r\n"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at:at + size]
        parts.append(b"%x\r\n%b\r\n" % (len(part), part))
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    parts, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("a chunk's length does not fit")
        parts.append(body[at:at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response with its transfer framing undone."""
    head, mark, body = block.partition(_END)
    if not mark:
        raise ValueError("no end of the HTTP header")
    fields = {k.strip().lower(): v.strip().lower() for k, _, v in
              (line.partition(b":") for line in head.split(b"\r\n")[1:])}
    return dechunked(body) if fields.get(b"transfer-encoding") == b"chunked" else body


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + _END + block


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}').urn}>"


def _uri(url: str | None) -> str | None:
    return None if url is None else "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def page_records(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool,
                 copy: str, segment: int = SEGMENT) -> Iterator[bytes]:
    """The records of one page; copy sets rows of one id and payload apart."""
    digest = digest_of(payload)
    own = _record_id(page_id, digest)
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", own), ("WARC-Date", DATE),
              ("WARC-Target-URI", _uri(url)), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("Content-Type", "application/http; msgtype=response"),
              ("X-Page-ID", page_id), ("X-Payload-Length", len(payload)), ("X-Copy", copy)]
    if revisit:
        yield record([*fields, ("WARC-Profile", REVISIT), ("WARC-Refers-To", _record_id(refers_to, digest)),
                      ("X-Refers-To-Page", refers_to)], _HTTP)
        return
    block = _HTTP + chunked(payload)
    if len(block) <= segment:
        yield record(fields, block)
        return
    yield record([*fields, ("WARC-Segment-Number", 1)], block[:segment])
    for number, at in enumerate(range(segment, len(block), segment), 2):
        last = at + segment >= len(block)
        yield record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{uuid.uuid5(uuid.UUID(own[10:-1]), f'{copy}:{number}').urn}>"),
                      ("WARC-Date", DATE), ("WARC-Target-URI", _uri(url)), ("WARC-Segment-Origin-ID", own),
                      ("WARC-Segment-Number", number), ("WARC-Segment-Total-Length", len(block) if last else None),
                      ("X-Copy", copy)], block[at:at + segment])


def read_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of every record of an archive."""
    while True:
        line = stream.readline()
        while line == b"\r\n":
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError("not at the start of a record")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != _END:
            raise ValueError("a record's length does not fit")
        yield fields, block


def write_archives(pages: DataFrame, min_bytes: int = 0, segment: int = SEGMENT, archive: int = ARCHIVE) -> str:
    """Write the pages as WARC archives; returns their folder."""
    spark = pages.sparkSession
    path = work_path(spark, "warc")
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                         F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    plain = plain.withColumn("sha1", F.sha1("payload"))
    large = plain.filter(F.length("payload") >= min_bytes)
    again = large.groupBy("sha1").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = written(again.select("sha1", "last"), "repeated-payloads")
    # a plain exchange on either side: Spark splits the partition of a hot payload
    rows = plain.join(again, "sha1", "left").select(
        F.col("page_id").cast("string").alias("page_id"), "url", "payload", F.col("last").cast("string").alias("last"),
        (F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
         & (F.length("payload") >= min_bytes)).alias("revisit"))

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task, number, parts, size = TaskContext.get().partitionId(), 0, [], 0
        for frame in frames:
            for page_id, url, payload, last, revisit in frame.itertuples(index=False):
                page_id = None if pd.isna(page_id) else int(page_id)
                number += 1
                for one in page_records(page_id, url, payload, int(last) if revisit else None, revisit,
                                        f"{task}-{number}", segment):
                    parts.append(one)
                    size += len(one)
                    if size >= archive:
                        yield pd.DataFrame({"archive": [_END.join(parts)]})
                        parts, size = [], 0
        if parts:
            yield pd.DataFrame({"archive": [_END.join(parts)]})

    archives = rows.mapInPandas(build, "archive binary")
    (archives.select(F.col("archive").cast("string")).write.option("lineSep", _END.decode())
     .option("maxRecordsPerFile", 1).option("compression", "gzip").text(path))
    return path


_PARSED = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "origin string, copy string, segment int, total long, block binary")
_NUMBERS = frozenset(f.split()[0] for f in _PARSED.split(", ") if f.endswith((" long", " int")))
RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _finished(fields: dict[str, str], block: bytes) -> tuple:
    number = lambda name: int(fields[name]) if name in fields else None
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response":
        payload = payload_of(block)
        if digest_of(payload) != digest or len(payload) != number("x-payload-length"):
            raise ValueError(f"payload of {fields['warc-record-id']} does not fit its digest")
    return number("x-page-id"), number("x-payload-length"), digest, fields["warc-type"], number("x-refers-to-page")


def _parse(contents: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [f.split()[0] for f in _PARSED.split(", ")]
    for frame in contents:
        for content in frame["content"]:
            rows = []
            with gzip.GzipFile(fileobj=io.BytesIO(content)) as stream:
                for fields, block in read_records(stream):
                    segment = int(fields.get("warc-segment-number", 0))
                    if not segment:
                        rows.append((*_finished(fields, block), None, None, None, None, None))
                        continue
                    first = fields["warc-type"] != "continuation"
                    origin = fields["warc-record-id" if first else "warc-segment-origin-id"]
                    total = fields.get("warc-segment-total-length")
                    head = (int(fields["x-page-id"]) if "x-page-id" in fields else None,
                            int(fields["x-payload-length"]), fields["warc-payload-digest"], fields["warc-type"],
                            None) if first else (None,) * 5
                    rows.append((*head, origin, fields["x-copy"], segment, int(total) if total else None, block))
            columns = dict(zip(names, zip(*rows) if rows else [()] * len(names)))
            yield pd.DataFrame({c: pd.Series(list(x), dtype="Int64" if c in _NUMBERS else object) for c, x in columns.items()})


def _reassemble(segments: pd.DataFrame) -> pd.DataFrame:
    segments = segments.sort_values("segment")
    first, last = segments.iloc[0], segments.iloc[-1]
    block = b"".join(segments["block"])
    if list(segments["segment"]) != list(range(1, len(segments) + 1)) or last["total"] != len(block):
        raise ValueError(f"segments of {first['origin']} are not whole")
    fields = {"warc-type": first["record_type"], "warc-record-id": first["origin"],
              "warc-payload-digest": first["payload_digest"], "x-payload-length": str(int(first["payload_bytes"]))}
    if not pd.isna(first["page_id"]):
        fields["x-page-id"] = str(int(first["page_id"]))
    out = pd.DataFrame([_finished(fields, block)], columns=[f.split()[0] for f in RESULT.split(", ")])
    return out.astype({c: "Int64" for c in ("page_id", "payload_bytes", "refers_to")})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per page: page_id, payload_bytes, payload_digest, record_type,
    refers_to."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    parsed = written(files.mapInPandas(_parse, _PARSED), "warc-records")
    names = [f.split()[0] for f in RESULT.split(", ")]
    whole = parsed.filter(F.col("segment").isNull()).select(*names)
    parts = parsed.filter(F.col("segment").isNotNull())
    # ids as text: pandas makes floats of longs beside nulls
    parts = parts.withColumn("page_id", F.col("page_id").cast("string"))
    return whole.unionByName(parts.groupBy("origin", "copy").applyInPandas(_reassemble, RESULT))


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    return read_archives(pages.sparkSession, write_archives(pages, min_bytes))

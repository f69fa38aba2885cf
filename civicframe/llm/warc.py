"""WARC archives: write one gzip member a record, read them back by byte ranges.

A reading task gets a byte range of a file. It looks for the gzip magic from the start of the range, takes the first
place where a member with a WARC header decodes, and then owns each record whose member starts inside the range; the
last of them may end beyond it. So every record has one owner, whatever the ranges.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicframe.llm.common import open_store, shared_path, stored

MAGIC = b"\x1f\x8b\x08"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
STEP = 1 << 14
_ID = re.compile(rb"<urn:x-page:(-?\d+|none)>")
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def with_revisits(pages: DataFrame, *, id_col: str, payload_col: str, min_bytes: int = 0) -> DataFrame:
    """Add ``_response``: the largest id among the rows with an equal payload, null for payloads under ``min_bytes``.

    The grouped side holds a digest and an id for each payload; the join is an equi-join that adaptive execution
    can split where one payload makes up much of the table.
    """
    keyed = pages.withColumn("_sha1", F.sha1(F.coalesce(F.col(payload_col), F.lit("")).cast("binary")))
    largest = keyed.groupBy("_sha1").agg(F.max(id_col).alias("_response"))
    size = F.octet_length(F.coalesce(F.col(payload_col), F.lit("")))
    return keyed.join(largest, "_sha1", "left").withColumn("_response", F.when(size >= min_bytes, F.col("_response")))


def record(page_id: int | None, url: str | None, payload: bytes, response: int | None) -> bytes:
    """One record; ``response`` is the id of the page that this one revisits, or None."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if response is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if response is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{'none' if page_id is None else page_id}>",
        f"WARC-Target-URI: {_UNSAFE.sub(lambda m: f'%{ord(m[0]):02X}', url or '')}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        *([] if response is None else [f"WARC-Refers-To: <urn:x-page:{response}>", f"WARC-Profile: {PROFILE}"]),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    """``data`` as one gzip member in which no other member with a WARC header seems to start.

    A stored deflate block can hold a payload that is itself an archive; in such a member the packer is flushed inside
    each gzip magic of the payload, which puts bytes of its own there.
    """
    out = b""
    # the last layout leaves no two bytes of the payload side by side with a third, so no gzip magic either
    for cuts in ([], [m.start() + 1 for m in re.finditer(re.escape(MAGIC), data)], range(2, len(data), 2)):
        z = zlib.compressobj(level, zlib.DEFLATED, 31)
        out = b"".join(z.compress(data[i:j]) + z.flush(zlib.Z_FULL_FLUSH if j < len(data) else zlib.Z_FINISH) for i, j in zip([0, *cuts], [*cuts, len(data)], strict=True))
        at = out.find(MAGIC, 1)
        while at >= 0 and not begins_record(out[at : at + 4096]):
            at = out.find(MAGIC, at + 1)
        if at < 0:
            break
    return out


def begins_record(data: bytes) -> bool:
    """Whether a gzip member that starts here decodes to the header of a WARC record."""
    try:
        return zlib.decompressobj(31).decompress(data, 64).startswith(b"WARC/1.")
    except zlib.error:
        return False


def write_archives(pages: DataFrame, uri: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", level: int = 4, file_bytes: int = 1 << 30) -> DataFrame:
    """Write each row of ``pages`` as a record into archives below ``uri``; return (path, size, records) of the files.

    ``pages`` has ``_response`` from :func:`with_revisits`. Rows with a null id are written with the id ``none``; of
    equal payloads that all have null ids, each is a response. Repeated rows with the largest id are all responses.
    Each attempt of a task writes files of its own name and the returned list, which is stored, names those of the
    attempt that counted, so that a lost or repeated task leaves nothing behind that is read.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_store(uri)
        fs.create_dir(base, recursive=True)
        out, path, size, count, done = None, "", 0, 0, []
        for batch in batches:
            for page_id, url, payload, response in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    path, size, count = f"{base}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(path, compression=None)
                data = member(record(page_id, url, payload or b"", None if response == page_id else response), level)
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= file_bytes:
                    out.close()
                    out = done.append((path, size, count))
        if out is not None:
            out.close()
            done.append((path, size, count))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], ["path", "size", "records"])

    columns = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(payload_col).cast("binary"), F.col("_response").cast("long"))
    return stored(columns.mapInArrow(write, "path string, size long, records long"), "warc-files")


def members(f, pos: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Offset and content of the members that follow one another from ``pos`` and start before ``end``."""
    f.seek(pos)
    buffer = b""
    at = 0  # of the next byte of buffer
    while pos < end:
        z, parts, used = zlib.decompressobj(31), [], 0
        while not z.eof:
            if at >= len(buffer):
                buffer, at = f.read(1 << 20), 0
                if not buffer:
                    if used:
                        raise EOFError(f"the member at {pos} is cut off")
                    return
            piece = buffer[at : at + STEP]
            parts.append(z.decompress(piece))
            took = len(piece) - len(z.unused_data)
            at, used = at + took, used + took
        yield pos, b"".join(parts)
        pos += used


def first_member(f, start: int, end: int) -> int | None:
    """Offset of the first record that starts in [start, end)."""
    step, at = 1 << 20, start
    while at < end:
        f.seek(at)
        data = f.read(step + 2)
        i = data.find(MAGIC)
        while 0 <= i < step and at + i < end:
            tail = data[i : i + 4096]
            if len(tail) < 4096:  # near the end of what was read
                f.seek(at + i)
                tail = f.read(4096)
            if begins_record(tail):
                return at + i
            i = data.find(MAGIC, i + 1)
        at += step
    return None


def parsed(data: bytes) -> dict:
    """The fields of a record; the digest of a response is computed from its payload and held against the header."""
    head, _, rest = data.partition(b"\r\n\r\n")
    field = {k.lower(): v for k, _, v in (x.partition(b": ") for x in head.split(b"\r\n")[1:])}
    http, _, payload = rest[: int(field[b"content-length"])].partition(b"\r\n\r\n")
    length = int(re.search(rb"(?i)content-length: (\d+)", http)[1])
    number = lambda x: int(x) if x != b"none" else None
    kind, said = field[b"warc-type"].decode(), field[b"warc-payload-digest"].decode().removeprefix("sha1:")
    if kind == "response":
        own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if own != said or len(payload) != length:
            raise ValueError(f"the payload of {field[b'warc-record-id']!r} is damaged")
    to = _ID.fullmatch(field[b"warc-refers-to"]) if kind == "revisit" else None
    return {"page_id": number(_ID.fullmatch(field[b"warc-record-id"])[1]), "url": field[b"warc-target-uri"].decode(), "payload_bytes": length, "payload_digest": said, "record_type": kind, "refers_to": to and number(to[1]), "payload": payload if kind == "response" else None}


RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_archives(files: DataFrame, *, split_bytes: int = 64 << 20, with_payload: bool = True) -> DataFrame:
    """The records of ``files`` (path, size). Tasks take byte ranges of ``split_bytes``, not files."""
    spark = files.sparkSession
    total = files.agg(F.sum("size")).first()[0] or 0
    ranges = files.where("size > 0").select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    tasks = max(spark.sparkContext.defaultParallelism, min(total // split_bytes, 100_000))
    fields = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
    scheme = shared_path(spark, "x")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_store(scheme)
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, held = [], 0
                with fs.open_input_file(path) as f:
                    pos = first_member(f, start, start + split_bytes)
                    for _, data in members(f, pos, start + split_bytes) if pos is not None else ():
                        rows.append(r := parsed(data))
                        if not with_payload:
                            r["payload"] = None
                        held += len(r["payload"] or b"") + 200
                        if held > 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, fields)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, fields)

    return ranges.repartition(int(tasks)).mapInArrow(read, RECORDS)


def archive(pages: DataFrame, uri: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` with equal payloads stored once; return the list of files.

    Null payloads count as empty ones. Null urls become empty ones, and characters that would break a header are
    percent-encoded. Columns other than these three are ignored. An empty table gives an empty list of files.
    """
    return write_archives(with_revisits(pages.select(id_col, url_col, payload_col), id_col=id_col, payload_col=payload_col, min_bytes=min_bytes), uri, id_col=id_col, url_col=url_col, payload_col=payload_col)

"""WARC archives of gzip members: a writer with revisit records, and a reader that splits archives by byte range."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import bounded_batches, discard, filesystem, join_groups, place, table

_MAGIC = b"\x1f\x8b\x08"
_ID = "urn:x-page:"


@dataclass(frozen=True)
class WarcParams:
    """Date of the records; payload bytes from which equal payloads are revisits; bytes of a reader's range."""

    date: str = "2024-01-01T00:00:00Z"
    revisit_bytes: int = 0
    split_bytes: int = 8 << 20
    level: int = 6


def _record(page_id, url, payload: bytes, digest: str, refers_to, p: WarcParams) -> bytes:
    name = "none" if page_id is None else str(page_id)
    head = [b"WARC/1.1", b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"), f"WARC-Record-ID: <{_ID}{name}>".encode()]
    if url is not None:
        head.append(b"WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url).encode())
    head += [f"WARC-Date: {p.date}".encode(), f"WARC-Payload-Digest: sha1:{digest}".encode()]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_ID}{refers_to}>".encode(), b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    block = http + payload if refers_to is None else http
    head += [b"Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}".encode()]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _writer(folder: str, p: WarcParams):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        fs.create_dir(path, recursive=True)
        # a name of this attempt's own: only the files of attempts that came through are listed, and nothing is renamed
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        size = records = 0
        with fs.open_output_stream(f"{path}/{name}", compression=None) as out:
            for batch in batches:
                columns = (batch.column(x) for x in ("page_id", "url", "html", "sha1", "refers_to"))
                for page_id, url, html, sha1, refers_to in zip(*columns, strict=True):
                    payload = b"" if html.as_py() is None else html.as_buffer().to_pybytes()
                    digest = base64.b32encode(bytes.fromhex(sha1.as_py())).decode()
                    record = _record(page_id.as_py(), url.as_py(), payload, digest, refers_to.as_py(), p)
                    gz = zlib.compressobj(p.level, zlib.DEFLATED, 31)
                    member = gz.compress(record) + gz.flush()
                    out.write(member)
                    size += len(member)
                    records += 1
        yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "bytes": [size], "records": [records]})

    return write


def write_warc(pages: DataFrame, folder: str, params: WarcParams | None = None) -> DataFrame:
    """Write ``pages(page_id long, url string, html string, ...)`` to archives in ``folder``; ``path, bytes, records`` of each.

    Only the archives that are returned count: a task that failed or ran twice may leave others in the folder.

    The payload is the html in UTF-8, empty for null. Of records with equal payloads (SHA-1 and length) of at least
    ``revisit_bytes`` the one with the largest page_id is the response, the others are revisits of it; rows that repeat that
    page_id are responses too, and a null page_id is a response unless others share its payload. Digests are pre-aggregated
    before they are shuffled, and only the revisits' ids are joined to the pages.
    """
    p = params or WarcParams()
    pages = bounded_batches(pages).select(F.col("page_id").cast("long"), "url", "html")
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    keys = table(pages.select("page_id", F.sha1(payload).alias("sha1"), F.octet_length(payload).alias("bytes")), "digests")
    last = keys.filter(F.col("bytes") >= p.revisit_bytes).groupBy("sha1", "bytes").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
    revisits = join_groups(keys, last.filter("n > 1"), ["sha1", "bytes"], keys.count()).filter("not page_id <=> refers_to").select("page_id", "sha1", "refers_to").distinct()
    revisits = table(revisits, "revisits")
    discard(keys)
    rows = pages.withColumn("sha1", F.sha1(payload)).alias("p").join(
        revisits.alias("r"), F.expr("p.page_id <=> r.page_id and p.sha1 = r.sha1"), "left"
    )
    rows = rows.select("p.page_id", "p.url", "p.html", "p.sha1", "r.refers_to")
    return table(rows.mapInArrow(_writer(folder, p), "path string, bytes long, records long"), "archives")


class _Range:
    """Buffered reads of a file at growing offsets."""

    def __init__(self, file, size: int, step: int = 1 << 20) -> None:
        self.file, self.size, self.step, self.at, self.data = file, size, step, 0, b""

    def get(self, at: int, n: int) -> bytes:
        """Up to n bytes from ``at``; fewer only at the end of the file."""
        if not (self.at <= at and at + n <= self.at + len(self.data)):
            if not self.at <= at <= self.at + len(self.data):
                self.data = b""
            else:
                self.data = self.data[at - self.at :]
            self.at = at
            missing = min(self.size - at, max(n, self.step)) - len(self.data)
            if missing > 0:
                self.file.seek(at + len(self.data))
                self.data += self.file.read(missing)
        return self.data[at - self.at : at - self.at + n]


def _member(source: _Range, at: int) -> tuple[bytes, int] | None:
    """The decoded gzip member at ``at`` and its end, or None if none of a WARC record is there."""
    head = source.get(at, 10)
    if len(head) < 10 or head[:3] != _MAGIC or head[3] & 0xE0:
        return None
    gz, parts, begun = zlib.decompressobj(31), [], False
    try:
        while not gz.eof:
            piece = source.get(at, 64 << 10)
            if not piece:
                return None
            at += len(piece)
            parts.append(gz.decompress(piece))
            if not begun and sum(map(len, parts[:2])) >= 5:
                begun = True
                if not b"".join(parts[:2]).startswith(b"WARC/"):
                    return None
    except zlib.error:
        return None
    data = b"".join(parts)
    return (data, at - len(gz.unused_data)) if data.startswith(b"WARC/") else None


def _members(source: _Range, start: int, end: int) -> Iterator[bytes]:
    """Decoded members that begin in [start, end)."""
    at = start
    while at < end:
        found = _member(source, at)
        if found:
            yield found[0]
            at = found[1]
            continue
        block = source.get(at + 1, 1 << 20)  # a false or no candidate: on to the next magic
        if not block:
            return
        next_ = block.find(_MAGIC)
        at = at + 1 + (next_ if next_ >= 0 else max(1, len(block) - 2))


def _parsed(record: bytes) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        fields[key.strip().lower()] = value.strip().decode()
    block = rest[: int(fields[b"content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
    digest = fields[b"warc-payload-digest"].partition(":")[2]
    kind = fields[b"warc-type"]
    if kind == "response" and (len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload of {fields[b'warc-record-id']} differs from its digest")
    number = lambda x: None if x is None or x.endswith(":none>") else int(x[len(_ID) + 1 : -1])
    return {
        "page_id": number(fields[b"warc-record-id"]), "url": fields.get(b"warc-target-uri"), "record_type": kind, "payload_bytes": length,
        "payload_digest": digest, "refers_to": number(fields.get(b"warc-refers-to")), "payload": payload if kind == "response" else None,
    }


_RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
_ARROW = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
     ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
)


def _reader(payloads: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for split in batch.to_pylist():
                fs, path = filesystem(split["path"])
                with fs.open_input_file(path) as file:
                    rows, held = [], 0
                    for record in _members(_Range(file, file.size()), split["start"], split["end"]):
                        row = _parsed(record)
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        held += len(row["payload"] or b"") + 200
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _ARROW)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)

    return read


def read_warc(archives: DataFrame, params: WarcParams | None = None, payloads: bool = True) -> DataFrame:
    """The records of ``archives(path string, bytes long, ...)``.

    Every archive is cut into ranges of ``split_bytes``; a task looks for gzip magic in its range, takes a candidate as a
    member only if its header is valid and it decodes, checksum included, to a WARC record, and owns the records that start
    inside, reading on past the range's end for the last. Response payloads are checked against their digests.
    """
    p = params or WarcParams()
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(p.split_bytes).cast("long"))
    splits = archives.filter("bytes > 0").select("path", "bytes", F.explode(starts).alias("start"))
    splits = splits.select("path", "start", F.least(F.col("start") + p.split_bytes, "bytes").alias("end"))
    partitions = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return splits.repartition(partitions, "path", "start").mapInArrow(_reader(payloads), _RECORD)


def round_trip(spark: SparkSession, pages: DataFrame, params: WarcParams | None = None, payloads: bool = True) -> DataFrame:
    """Write ``pages`` to fresh archives in the shared folder and read them back."""
    return read_warc(write_warc(pages, place(spark, "warc"), params), params, payloads)

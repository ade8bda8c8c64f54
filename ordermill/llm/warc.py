"""WARC archives: a writer, and a splittable reader.

Archives are gzip files with one member for each record. Tasks write them through ``pyarrow.fs``, which
reaches the folder by its address (file, s3, gs, hdfs); each attempt writes a file of its own name, and
only those that a finished attempt reports are in the manifest, a table next to them, with their records counted.

The reader deals byte ranges to tasks. A task looks for gzip's magic number from the range's start,
takes a place for a member's start only if the header decodes and the content begins like a WARC record, and owns
the records that start inside its range, reading on past the range's end for the last one. From one owned
member the next starts where its compressed data ends; a gap is searched again.

Of rows with equal payloads of at least ``LEAST`` bytes those with the largest page_id are responses, the
others revisits of it, without payload. A null page_id counts as smallest; if all ids of a group are null,
all are responses, as are rows that repeat the largest id. Null html is an empty payload.

Records of other writers are read as well: a record without a type has a null one, ids and digests of
another form are null.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ordermill.llm.common import bounded_batches, written
from ordermill.session import fresh_dir

LEAST = 1000
#: Bytes of archive in one range.
RANGE = 16 << 20
CHUNK = 1 << 18
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"

RECORDS = (
    "record_id string, record_type string, target_uri string, page_id long, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary, path string, at long"
)


def _file_system(address: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(address if ":/" in address else f"file://{address}")


def _name(page_id: int | None, row: int) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}:{row}"


def record(record_type: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = [("WARC-Type", record_type), *headers, ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in lines)
    packed = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packed.compress(head + b"\r\n" + block + b"\r\n\r\n") + packed.flush()


def _digest(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, url, payload, holder): ``holder`` is the largest page_id with that payload, null for responses."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    )
    large = F.length("payload") >= least
    sized = rows.withColumn("digest", F.when(large, F.sha2("payload", 256)))
    groups = sized.where("digest is not null").groupBy("digest").agg(F.max("page_id").alias("holder"), F.count("*").alias("n"))
    # A table of its own: its size is known to the planner, and a common payload's rows can be split.
    groups = written(groups.where("n > 1 and holder is not null").select("digest", "holder"), "equal-payloads")
    joined = sized.join(groups, "digest", "left")
    return joined.select(
        "page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder")).alias("holder")
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes ``with_revisits`` rows as archives under ``folder``; the manifest (path, bytes, records)."""
    bounded_batches(pages.sparkSession)

    def write(batches):
        files, path = _file_system(folder)
        files.create_dir(path, recursive=True)
        context = TaskContext.get()
        name = f"{path}/part-{context.partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        written_bytes = row = 0
        with files.open_output_stream(name, compression=None) as out:
            for batch in batches:
                for page_id, url, payload, holder in zip(*(c.to_pylist() for c in batch.columns)):
                    row += 1
                    number = (context.partitionId() << 32) + row
                    headers = [
                        ("WARC-Record-ID", f"<{_name(page_id, number)}>"),
                        ("WARC-Target-URI", " ".join((url or "").split())),
                        ("WARC-Payload-Digest", _digest(payload)),
                        ("X-Page-ID", "" if page_id is None else str(page_id)),
                    ]
                    if holder is None or (page_id is None and holder is None):
                        data = record("response", headers, payload)
                    else:
                        headers += [("WARC-Refers-To-Page", str(holder)), ("X-Payload-Length", str(len(payload)))]
                        headers.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
                        data = record("revisit", headers, b"")
                    out.write(data)
                    written_bytes += len(data)
        if row:
            columns = [pa.array([f"{folder}/{name.rsplit('/', 1)[1]}"]), pa.array([written_bytes]), pa.array([row])]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "bytes", "records"])

    rows = pages.select("page_id", "url", "payload", "holder")
    return written(rows.mapInArrow(write, "path string, bytes long, records long"), "warc-manifest")


class _Source:
    """Bytes of a file from anywhere, read in chunks."""

    def __init__(self, file: pa.NativeFile, size: int):
        self.file, self.size = file, size
        self.start, self.held = 0, b""

    def read(self, at: int, least: int = 1) -> bytes:
        """What is held from ``at`` on: at least ``least`` bytes, fewer only at the file's end."""
        if not self.start <= at or self.start + len(self.held) < min(at + least, self.size):
            self.file.seek(at)
            self.start, self.held = at, self.file.read(min(max(least, CHUNK), self.size - at))
        return self.held[at - self.start :]

    def find(self, mark: bytes, at: int, stop: int) -> int:
        """The first place of ``mark`` that starts in [at, stop), or -1."""
        while at < stop:
            data = self.read(at, len(mark))
            found = data.find(mark)
            if found >= 0:
                return at + found if at + found < stop else -1
            if len(data) < len(mark) or at + len(data) >= self.size:
                return -1
            at += len(data) - len(mark) + 1
        return -1


def _member(source: _Source, at: int) -> tuple[bytes, int] | None:
    """The content of the member at ``at`` and where it ends, or None if no WARC record is there."""
    inflate, parts, place, known = zlib.decompressobj(31), [], at, False
    try:
        while not inflate.eof:
            data = source.read(place)
            if not data:
                return None
            parts.append(inflate.decompress(data))
            place += len(data)
            if not known:
                head = b"".join(parts)
                if len(head) >= 7:
                    if not head.startswith(b"WARC/1."):
                        return None
                    known = True
    except zlib.error:
        return None
    return (b"".join(parts), place - len(inflate.unused_data)) if known else None


def _parsed(content: bytes) -> tuple[dict[str, str], bytes] | None:
    head, mark, rest = content.partition(b"\r\n\r\n")
    headers = {}
    for line in head.split(b"\r\n")[1:]:
        key, colon, value = line.partition(b":")
        headers[key.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = headers.get("content-length", "")
    if not mark or not length.isdigit() or len(rest) < int(length):
        return None
    return headers, rest[: int(length)]


def records_in(source: _Source, start: int, stop: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(place, headers, block) of the records that start in [start, stop)."""
    at = start
    while 0 <= (at := source.find(MAGIC, at, stop)):
        member = _member(source, at)
        parsed = _parsed(member[0]) if member else None
        if parsed is None:
            at += 1
            continue
        yield at, *parsed
        at = member[1]


def _number(text: str | None) -> int | None:
    """The number a header holds; null for none, for other text and beyond 64 bits."""
    number = int(text) if text and re.fullmatch(r"-?[0-9]{1,19}", text) else None
    return number if number is not None and -(1 << 63) <= number < 1 << 63 else None


def _hex(digest: str) -> str | None:
    """Hexadecimal digits of a base 32 digest; null if it is none."""
    try:
        return base64.b32decode(digest).hex()
    except ValueError:
        return None


def read_archives(manifest: DataFrame, size: int = RANGE) -> DataFrame:
    """``RECORDS`` of all archives in ``manifest`` (path, bytes), by byte ranges of ``size``."""
    spark = manifest.sparkSession
    bounded_batches(spark)
    ranges = manifest.select(
        "path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(size).cast("long"))).alias("start")
    )
    tasks = max(ranges.count(), 1)
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[t]) for n, t in (x.split() for x in RECORDS.split(", "))])

    def read(batches):
        rows, held = [], 0
        for batch in batches:
            for path, length, start in zip(*(c.to_pylist() for c in batch.columns)):
                files, inner = _file_system(path)
                with files.open_input_file(inner) as file:
                    for at, headers, block in records_in(_Source(file, length), start, min(start + size, length)):
                        algorithm, _, digest = headers.get("warc-payload-digest", "").partition(":")
                        own = hashlib.sha1(block).hexdigest()
                        kind = headers.get("warc-type")
                        if kind == "revisit":
                            own = _hex(digest) if algorithm == "sha1" else None
                        stated = _number(headers.get("x-payload-length"))
                        rows.append((
                            headers.get("warc-record-id"), kind, headers.get("warc-target-uri"),
                            _number(headers.get("x-page-id")), _number(headers.get("warc-refers-to-page")),
                            len(block) if stated is None else stated, own,
                            block if kind == "response" else None, path, at,
                        ))
                        held += len(block)
                        if held > 1 << 22:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return ranges.repartition(tasks).mapInArrow(read, RECORDS)


def archive(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes ``pages`` as archives in the shared folder and reads them back: ``RECORDS``."""
    return read_archives(write_archives(with_revisits(pages), fresh_dir(spark, "llm-warc")))


#: The digest columns in SQL.
ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
g AS (SELECT html, max(page_id) AS holder FROM p WHERE n >= 1000 GROUP BY html)
SELECT page_id, n AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN holder <> page_id THEN holder END AS refers_to
FROM p LEFT JOIN g ON p.html = g.html
"""

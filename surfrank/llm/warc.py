"""WARC archives: one gzip member per record, written by tasks and read back as streams.

Writer: each task appends its records to archives of about ``archive_bytes`` in
a folder that all executors share, and returns a row for each archive.  Names
hold the task attempt, and only the archives whose rows the successful attempt
returned are read, so a lost executor leaves unused files and no double records.
Records with equal payloads of at least ``min_payload`` bytes are stored once:
the one with the largest page_id is the ``response``, the others are
``revisit`` records without a payload.

Reader: tasks take archives and go through each in order, a block of bytes at
a time: incremental decompression of one gzip member, the header up to the
blank line, then exactly Content-Length bytes, whose digests are compared with
those of the header.  Memory holds one record.

A null html is an empty payload.  Rows that repeat both page_id and payload are
a response each, as neither is larger; a null page_id is smaller than any, and a revisit or response like the others.
No pages give no archives and no rows.  A null url is an empty target.
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
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surfrank.llm.tables import settled, table
from surfrank.session import scratch_path

MIN_PAYLOAD = 1000
ARCHIVE_BYTES = 64 << 20
#: Speed against size of zlib, 1 to 9.
LEVEL = 4
READ_BYTES = 1 << 18
CRLF = b"\r\n"
ARCHIVES = "path string, records long, bytes long"
RECORDS = "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long, digests_ok boolean"


def _uri(folder: str) -> str:
    """The folder as Arrow's file systems want it: with a scheme, and three slashes for a local or mounted path."""
    if re.match(r"[a-zA-Z][\w+.-]*://", folder):
        return folder
    return "file://" + folder.removeprefix("file:")


def _label(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def _record_id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record_bytes(page_id, url: str | None, payload: bytes, response_id=None, revisit: bool = False) -> bytes:
    """One WARC record; a revisit names the record that has its payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "WARC-Target-URI: " + (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: {_label(hashlib.sha1(payload).digest())}",
        f"WARC-Block-Digest: {_label(hashlib.sha1(block).digest())}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(response_id)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + CRLF * 2 + block + CRLF * 2


def _writer(folder: str, archive_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        stem = f"{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        out, path, made, n, size = None, "", [], 0, 0

        def close():
            nonlocal out
            out.close()
            out = None
            made.append((f"{folder}/{path}", n, size))

        for batch in batches:
            for page_id, url, html, response_id, revisit in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "response_id", "revisit"))):
                if out is None:
                    path, n, size = f"{stem}-{len(made):04d}.warc.gz", 0, 0
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{root}/{path}", compression=None)
                z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = z.compress(record_bytes(page_id, url, (html or "").encode(), response_id, revisit)) + z.flush()
                out.write(member)
                n, size = n + 1, size + len(member)
                if size >= archive_bytes:
                    close()
        if out is not None:
            close()
        columns = list(zip(*made)) if made else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["path", "records", "bytes"])

    return write


def write_archives(pages: DataFrame, folder: str, min_payload: int = MIN_PAYLOAD, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html); a row for each archive written.

    The response of each repeated payload is found on (digest, page_id) alone
    and kept, so the join with the pages has a plain exchange on both sides
    and Spark can split the partition of a page with very many copies.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    keyed = rows.withColumn("size", F.octet_length(payload)).withColumn("digest", F.when(F.col("size") >= min_payload, F.sha1(payload)))
    repeated = settled(
        keyed.where("digest IS NOT NULL").groupBy("digest").agg(F.max("page_id").alias("response_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    # payloads too short for a digest match nothing; keys of their own keep them from sharing a partition
    keyed = keyed.withColumn("key", F.coalesce("digest", F.concat(F.lit("-"), F.xxhash64("page_id", "url", "html").cast("string")))).drop("digest", "size")
    role = keyed.join(repeated.withColumnRenamed("digest", "key"), "key", "left").select(
        "page_id", "url", "html", "response_id", (F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))).alias("revisit")
    )
    return settled(role.mapInArrow(_writer(_uri(folder), archive_bytes), ARCHIVES).where("records > 0"))


class RecordStream:
    """Records of one archive, read a block at a time."""

    def __init__(self, source):
        self.source, self.raw = source, b""

    def _members(self) -> Iterator[Iterator[bytes]]:
        while True:
            if not self.raw:
                self.raw = self.source.read(READ_BYTES)
            if not self.raw:
                return
            yield self._member()

    def _member(self) -> Iterator[bytes]:
        z = zlib.decompressobj(31)
        while not z.eof:
            if not self.raw:
                self.raw = self.source.read(READ_BYTES)
                if not self.raw:
                    raise EOFError("the archive ends within a gzip member")
            part = z.decompress(self.raw, READ_BYTES)
            self.raw = z.unused_data if z.eof else z.unconsumed_tail
            if part:
                yield part

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        for member in self._members():
            have = bytearray()
            for part in member:
                have += part
                if (end := have.find(CRLF * 2)) >= 0:
                    break
            else:
                raise ValueError("a record has no blank line after its header")
            lines = have[:end].decode().split("\r\n")
            header = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            length = int(header["content-length"])
            del have[: end + 4]
            for part in member:
                have += part
            if len(have) != length + 4 or have[length:] != CRLF * 2:
                raise ValueError("a record's length differs from its Content-Length")
            yield header, bytes(have[:length])


def _page_id(record_id: str):
    number = record_id[len("<urn:page:") : -1]
    return int(number) if number else None


def parse_record(header: dict[str, str], block: bytes) -> tuple:
    """A row of RECORDS."""
    http, _, payload = block.partition(CRLF * 2)
    revisit = header["warc-type"] == "revisit"
    digest = header["warc-payload-digest"]
    ok = _label(hashlib.sha1(block).digest()) == header["warc-block-digest"] and (revisit or _label(hashlib.sha1(payload).digest()) == digest)
    size = next(int(x[15:]) for x in http.split(CRLF) if x.lower().startswith(b"content-length:"))
    ok = ok and (revisit or size == len(payload))
    return (
        _page_id(header["warc-record-id"]),
        header.get("warc-target-uri", ""),
        header["warc-type"],
        None if revisit else payload,
        size,
        base64.b32decode(digest[5:]).hex(),
        _page_id(header["warc-refers-to"]) if revisit else None,
        ok,
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
    names = ["page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to", "digests_ok"]
    flush = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
    for batch in batches:
        for path in batch.column("path").to_pylist():
            fs, at = pafs.FileSystem.from_uri(path)
            rows, size = [], 0
            with fs.open_input_stream(at, compression=None) as source:
                for header, block in RecordStream(source):
                    rows.append(parse_record(header, block))
                    size += len(block)
                    if len(rows) >= 2000 or size > 4 << 20:
                        yield flush(rows)
                        rows, size = [], 0
            if rows:
                yield flush(rows)


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of the archives named in column ``path``; digests_ok is false where a digest differs."""
    return archives.select("path").mapInArrow(_read, RECORDS)


def op2_warc(spark, sf_dir):
    archives = write_archives(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    # an archive is a unit of reading: a task for each, which a shuffle of so few bytes would not give
    records = read_archives(archives.repartition(max(1, archives.count())))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digests_ok")


SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
q AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest,
             max(page_id) OVER (PARTITION BY sha1(payload)) AS last_id FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to,
       true AS digests_ok
FROM q
"""

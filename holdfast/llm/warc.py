"""WARC archives, written and read as a table of record chunks.

Writing: the digest of every payload is computed beside the scan; of payloads of
at least MIN_REVISIT bytes that occur more than once, the record of the largest
page_id keeps the payload and the others become revisit records that refer to it.
Payloads then become rows of record and chunk number that hold at most CHUNK bytes,
in the order of the scan, and each task streams these into gzip members, one a
record, of archives of its own in the shared folder, with a running SHA-1 that must
end at the record's digest. Only the archives of tasks that ended well are listed,
so a lost executor or a second attempt leaves nothing that is read.

Reading: archives are streamed. A payload becomes rows of record identifier and
chunk number that hold at most CHUNK bytes, with the payload's bytes and SHA-1 up
to and including that chunk; the row marked last carries those of the whole
payload. Neither side holds a whole archive or record beside the cell that Spark
itself reads a payload from.

Edge cases: null html is an empty payload; null ids and urls are left out of the
record's header and read back as null; a null id never is the response of a group
that has another; rows that repeat the largest page_id are responses all; an
empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, scratch

MIN_REVISIT = 1000
CHUNK = 1 << 20
ARCHIVE_BYTES = 64 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNKS = "record_id string, page_id long, url string, record_type string, refers_to long, chunk int, data binary, bytes_so_far long, digest_so_far string, last boolean, payload_bytes long, payload_digest string"


def record_uri(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>"


def record_head(page_id: int | None, url: str | None, digest: str, payload_bytes: int, refers_to: int | None) -> bytes:
    """All of a record before its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_uri(page_id, digest)}", f"WARC-Date: {DATE}"]
    lines += [f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}"] if url is not None else []
    lines += [f"X-Page-ID: {page_id}"] if page_id is not None else []
    lines += [f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}", "Content-Type: application/http;msgtype=response"]
    lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_uri(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"] if refers_to is not None else []
    lines += [f"Content-Length: {len(http) + (payload_bytes if refers_to is None else 0)}", "", ""]
    return "\r\n".join(lines).encode() + http


class ArchiveWriter:
    """Gzip members appended to a file of any store that Arrow opens."""

    def __init__(self, uri: str):
        self.fs, path = pa.fs.FileSystem.from_uri(uri)
        self.fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.uri, self.out, self.records, self.bytes = uri, self.fs.open_output_stream(path, compression=None), 0, 0

    def begin(self, head: bytes) -> None:
        self.pack = zlib.compressobj(1, zlib.DEFLATED, 31)
        self.put(head)

    def put(self, data: bytes | pa.Buffer) -> None:
        self._put(self.pack.compress(data))

    def end(self) -> None:
        self._put(self.pack.compress(b"\r\n\r\n") + self.pack.flush())
        self.records += 1

    def _put(self, data: bytes) -> None:
        self.bytes += len(data)
        self.out.write(data)

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.uri, self.records, self.bytes


def decide(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """pages with payload, payload_bytes, digest, and refers_to (null for a response)."""
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    copies = rows.where(F.col("payload_bytes") >= min_bytes).groupBy("digest", "payload_bytes").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    copies = materialise(copies.where("n > 1").drop("n"), "copies")
    joined = rows.join(copies, ["digest", "payload_bytes"], "left")
    return joined.select("page_id", "url", "payload", "payload_bytes", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def payload_chunks(decided: DataFrame, size: int = CHUNK) -> DataFrame:
    """The record and chunk rows of `decide`: a response's payload in pieces of at most size bytes, a revisit's single row without data."""
    own = F.col("refers_to").isNull()
    last = F.when(own, F.greatest(F.ceil(F.col("payload_bytes") / size), F.lit(1)) - 1).otherwise(F.lit(0)).cast("int")
    # a payload of one chunk is handed on as it is
    data = F.when(own & (F.col("last") == 0), F.col("payload")).when(own, F.substring("payload", F.col("chunk") * size + 1, F.lit(size)))
    rows = decided.select("*", last.alias("last")).select("*", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("chunk"))
    return rows.select("page_id", "url", "payload_bytes", "digest", "refers_to", "chunk", (F.col("chunk") == F.col("last")).alias("last"), data.alias("data"))


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, chunk: int = CHUNK) -> DataFrame:
    """Write the pages below folder; the archives as (archive, records, bytes)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done, out, sha, seen = TaskContext.get(), [], None, None, 0
        for batch in batches:
            data = batch.column("data")
            for i, r in enumerate(batch.drop_columns("data").to_pylist()):
                if not r["chunk"]:
                    out = out or ArchiveWriter(f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}-{len(done):04d}.warc.gz")
                    out.begin(record_head(r["page_id"], r["url"], r["digest"], r["payload_bytes"], r["refers_to"]))
                    sha, seen = hashlib.sha1(), 0
                if data[i].is_valid:
                    part = data[i].as_buffer()
                    out.put(part)
                    sha.update(part)
                    seen += part.size
                if r["last"]:
                    if r["refers_to"] is None and (sha.hexdigest(), seen) != (r["digest"], r["payload_bytes"]):
                        raise ValueError(f"the chunks of page {r['page_id']} do not join to its payload")
                    out.end()
                    if out.bytes >= archive_bytes:
                        done.append(out.close())
                        out = None
        if out is not None:
            done.append(out.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=["archive", "records", "bytes"])

    return materialise(payload_chunks(decide(pages), chunk).mapInArrow(write, "archive string, records long, bytes long"), "archives")


def read_records(stream: io.BufferedIOBase, chunk: int = CHUNK) -> Iterator[dict]:
    """The chunk rows of one archive, given its unpacked stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:40]!r}")
        head = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            head[name.lower()] = value.strip()
        left, http = int(head["content-length"]), {}
        left -= len(stream.readline())  # the status line
        while (line := stream.readline()).strip():
            left -= len(line)
            name, _, value = line.decode().partition(":")
            http[name.lower()] = value.strip()
        left -= len(line)
        digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
        kind, sha, seen, k = head["warc-type"], hashlib.sha1(), 0, 0
        row = {"record_id": head["warc-record-id"], "page_id": int(head["x-page-id"]) if "x-page-id" in head else None, "url": head.get("warc-target-uri"), "record_type": kind, "refers_to": int(head["x-refers-to-page-id"]) if kind == "revisit" else None, "payload_bytes": int(http["content-length"]), "payload_digest": digest}
        while True:
            data = stream.read(min(chunk, left))
            if left and not data:
                raise ValueError(f"{row['record_id']} is cut short")
            left -= len(data)
            seen += len(data)
            sha.update(data)
            if not left and kind == "response" and (sha.hexdigest() != digest or seen != row["payload_bytes"]):
                raise ValueError(f"{row['record_id']} does not match its digest")
            yield row | {"chunk": k, "data": data, "bytes_so_far": seen, "digest_so_far": sha.hexdigest(), "last": not left}
            k += 1
            if not left:
                break


def read_archives(archives: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The chunk table of the listed archives."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(CHUNKS))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for uri in batch.column("archive").to_pylist():
                fs, path = pa.fs.FileSystem.from_uri(uri)
                with fs.open_input_stream(path, compression=None) as raw, io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 18) as stream:
                    for row in read_records(stream, chunk):
                        rows.append(row)
                        size += len(row["data"])
                        if size >= 4 * chunk or len(rows) >= 2000:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    few = archives.select("archive").repartition(archives.sparkSession.sparkContext.defaultParallelism * 4, F.xxhash64("archive"))
    return few.mapInArrow(read, CHUNKS)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages and read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A response's bytes and digest are those counted over its chunks; a revisit's
    are those its record states.
    """
    archives = write_archives(pages, folder or scratch(pages.sparkSession, "warc"))
    rows = read_archives(archives).where("last")
    own = F.col("record_type") == "response"
    return rows.select("page_id", F.when(own, F.col("bytes_so_far")).otherwise(F.col("payload_bytes")).alias("payload_bytes"), F.when(own, F.col("digest_so_far")).otherwise(F.col("payload_digest")).alias("payload_digest"), "record_type", "refers_to")

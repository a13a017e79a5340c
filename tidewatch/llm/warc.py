"""WARC archives as a table of chunks: a row for each record and chunk number.

The chunks of a record, in order, are its bytes in the WARC format: chunk 0 has the headers of record and HTTP, the next
ones the payload, the last one ends with two line ends.  An oversized payload is many rows, so no step after the scan
holds a whole record, and every row of the spool carries the running length and SHA-1 of the payload up to its end.
Headers, and payloads of one chunk, are read where they lie; only longer payloads are shuffled to bring their chunks in
order.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import written

#: Payload bytes of a chunk.
CHUNK = 64 * 1024
#: Fixed by the WARC 1.1 standard.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNKS = "record_no long, chunk_no int, last boolean, data binary"
SPOOL = "record_no long, page_id long, url string, chunk_no int, last boolean, data binary, so_far long, digest string"
HEADERS = "record_no long, page_id long, url string, told string, kind string, refers_to long, size long, sent long"
#: Digest of no bytes.
NOTHING = base64.b32encode(hashlib.sha1().digest()).decode()
#: Bytes of chunks that a task passes on at once; numbers of revisits up to which they are broadcast.
PASSED, FEW = 8 << 20, 1_000_000


def _base32(sha1) -> str:
    return base64.b32encode(sha1.digest()).decode()


def spool(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """A row for each chunk of each page's payload (its html in UTF-8; null and empty: one empty chunk): ``record_no``,
    unique once written, ``page_id``, ``url``, ``chunk_no`` from 1, ``last``, ``data``, and of the payload so far ``so_far``
    bytes and ``digest``.  Payloads are cut in one pass over their bytes.  Other columns are ignored."""
    names = [x.split()[0] for x in SPOOL.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.binary(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record, rows, held = TaskContext.get().partitionId() << 40, [], 0

        def passed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
            rows.clear()
            return out

        for batch in batches:
            for page, url, html in zip(*(batch.column(c) for c in ("page_id", "url", "html")), strict=True):
                payload = memoryview(html.as_buffer() if html.is_valid else b"")
                sha1, ends = hashlib.sha1(), range(chunk, max(1, len(payload)) + chunk, chunk)
                for number, end in enumerate(ends, 1):
                    data = payload[end - chunk : end]
                    sha1.update(data)
                    rows.append((record, page.as_py(), url.as_py(), number, number == len(ends), bytes(data), end - chunk + len(data), _base32(sha1)))
                    held += len(data)
                    if held > PASSED:
                        yield passed()
                        held = 0
                record += 1
        if rows:
            yield passed()

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, SPOOL)


def archive(spooled: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The chunk table of a WARC archive with a record for each spooled page.

    Of records with equal payloads of at least ``least_bytes`` bytes, that with the smallest page_id (null last; of
    repeated rows any one) is a response and the others are revisits of it, without payload.  ``spooled`` has to be a
    written table, so that record numbers stay as they are.  Headers are rows of their own, so payloads stay where they
    are unless there are more than ``FEW`` revisits.
    """
    heads = spooled.where("last").select("record_no", "page_id", "url", F.col("so_far").alias("payload_bytes"), "digest")
    key = F.struct(F.col("page_id").isNull(), F.col("page_id"), F.col("record_no"))
    first = heads.where(F.col("payload_bytes") >= least_bytes).groupBy("digest", "payload_bytes").agg(F.min(key).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    # a payload that very many pages have is one key on the left, whose partition is split at run time
    typed = heads.join(first, ["digest", "payload_bytes"], "left")
    revisit = F.coalesce(F.col("first.record_no") != F.col("record_no"), F.lit(False))
    line = lambda *parts: F.concat(*(p if not isinstance(p, str) else F.lit(p) for p in parts), F.lit("\r\n"))
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    http = F.concat(line("HTTP/1.1 200 OK"), line("Content-Type: text/html; charset=utf-8"), line("Content-Length: ", text(F.col("payload_bytes"))), F.lit("\r\n"))
    block = F.length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    bare = revisit | (F.col("payload_bytes") == 0)
    header = F.concat(
        line("WARC/1.1"),
        line("WARC-Type: ", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID: <urn:page:", text(F.col("page_id")), ":", text(F.col("record_no")), ">"),
        line("WARC-Date: 1970-01-01T00:00:00Z"),
        F.when(F.col("url").isNotNull(), line("WARC-Target-URI: ", F.regexp_replace("url", "[\\r\\n]", " "))).otherwise(""),
        line("WARC-Payload-Digest: sha1:", F.col("digest")),
        F.when(revisit, F.concat(line("WARC-Refers-To: <urn:page:", text(F.col("first.page_id")), ":", text(F.col("first.record_no")), ">"), line(f"WARC-Profile: {REVISIT}"))).otherwise(""),
        line("Content-Type: application/http; msgtype=response"),
        line("Content-Length: ", text(block)),
        F.lit("\r\n"),
        http,
        F.when(bare, F.lit("\r\n\r\n")).otherwise(""),
    )
    typed = written(typed.select("record_no", revisit.alias("revisit"), bare.alias("last"), header.alias("header")), "warc-headers")
    headers = typed.select("record_no", F.lit(0).alias("chunk_no"), "last", F.encode("header", "UTF-8").alias("data"))
    again = typed.where("revisit").select("record_no")
    again = F.broadcast(again) if again.count() <= FEW else again
    payloads = spooled.where("octet_length(data) > 0").join(again, "record_no", "left_anti")
    return headers.union(payloads.select("record_no", "chunk_no", "last", F.when(F.col("last"), F.concat("data", F.lit(b"\r\n\r\n"))).otherwise(F.col("data")).alias("data")))


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the headers say; one that can't be read has nulls."""
    names = [x.split()[0] for x in HEADERS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]

    def own(x: str) -> int | None:
        n = x.strip("<>").split(":")[-2]
        return int(n) if n else None

    def read(data: bytes) -> tuple:
        try:
            head, _, http = data.decode().partition("\r\n\r\n")
            f = dict(x.split(": ", 1) for x in head.split("\r\n")[1:])
            http, _, _ = http.partition("\r\n\r\n") if "http" in f.get("Content-Type", "") else ("", "", "")
            size = int(f["Content-Length"]) - (len(http.encode()) + 4 if http else 0)
            sent = next((int(x.split(":")[1]) for x in http.split("\r\n") if x.lower().startswith("content-length:")), size)
            to = own(f["WARC-Refers-To"]) if "WARC-Refers-To" in f else None
            return own(f["WARC-Record-ID"]), f.get("WARC-Target-URI"), f["WARC-Payload-Digest"].removeprefix("sha1:"), f["WARC-Type"], to, size, sent
        except (KeyError, ValueError, IndexError):
            return (None,) * 7

    for batch in batches:
        rows = [read(data.as_buffer().to_pybytes()) for data in batch.column("data")]
        yield pa.RecordBatch.from_arrays([batch.column("record_no"), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(types[1:]))], names=names)


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Length and SHA-1 of payloads whose chunks follow each other, without the line ends after them."""
    at, sha1, size = None, hashlib.sha1(), 0
    for batch in batches:
        rows = []
        for record, last, data in zip(batch.column("record_no").to_pylist(), batch.column("last").to_pylist(), batch.column("data"), strict=True):
            if record != at:
                at, sha1, size = record, hashlib.sha1(), 0
            part = memoryview(data.as_buffer())
            part = part[: len(part) - 4] if last else part
            sha1.update(part)
            size += len(part)
            if last:
                rows.append((record, size, _base32(sha1)))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))], names=["record_no", "found_bytes", "found"])


def read_records(chunks: DataFrame) -> DataFrame:
    """The records of a chunk table, whatever its order: payload length and digest of a response are taken from its bytes,
    those of a revisit from its header.  ``verified`` is false where bytes and header disagree, as where a chunk is
    missing; a header that can't be read gives nulls."""
    heads = chunks.where("chunk_no = 0").select("record_no", "data").mapInArrow(_headers, HEADERS)
    alone = (F.col("chunk_no") == 1) & F.col("last")
    bodies = chunks.where("chunk_no > 0").select("record_no", "chunk_no", "last", "data")
    kind = "record_no long, found_bytes long, found string"
    parts = bodies.where(~alone).repartition("record_no").sortWithinPartitions("record_no", "chunk_no")
    found = bodies.where(alone).mapInArrow(_bodies, kind).unionByName(parts.mapInArrow(_bodies, kind))
    rows = heads.join(found, "record_no", "left")
    revisit = F.col("kind") == "revisit"
    size = F.coalesce("found_bytes", F.lit(0))
    digest = F.when(size > 0, F.col("found")).otherwise(NOTHING)
    return rows.select(
        "page_id", "url", F.when(revisit, F.col("sent")).otherwise(size).alias("payload_bytes"), F.when(revisit, F.col("told")).otherwise(digest).alias("payload_digest"),
        F.col("kind").alias("record_type"), "refers_to", F.coalesce((size == F.col("size")) & (revisit | (digest == F.col("told")) & (F.col("sent") == size)), F.lit(False)).alias("verified"),
    )


def export_files(chunks: DataFrame, folder: str) -> DataFrame:
    """Writes .warc.gz files, a gzip member for each record, into a mounted folder that all executors share; returns path and
    records of each file.  Rows are dealt by record and streamed in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        path, count, out = f"{folder}/part-{task.partitionId():05d}-{task.taskAttemptId()}.warc.gz", 0, None
        with open(path, "wb") as f:
            for batch in batches:
                for last, data in zip(batch.column("last").to_pylist(), batch.column("data"), strict=True):
                    out = out or gzip.GzipFile(fileobj=f, mode="wb", mtime=0)
                    out.write(data.as_buffer())
                    if last:
                        out.close()
                        out, count = None, count + 1
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count], pa.int64())], names=["path", "records"])

    ordered = chunks.repartition("record_no").sortWithinPartitions("record_no", "chunk_no")
    return ordered.select("last", "data").mapInArrow(run, "path string, records long")


def import_files(paths: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The chunk table of the .warc and .warc.gz files in ``paths(path string)``, streamed from a mounted folder."""

    def stream(path: str) -> Iterator[tuple[int, bool, bytes]]:
        with gzip.open(path) if path.endswith(".gz") else open(path, "rb") as f:
            while line := f.readline():
                if not line.strip():
                    continue
                head, size = line, 0
                while (line := f.readline()).strip():
                    head += line
                    if line.lower().startswith(b"content-length:"):
                        size = int(line.split(b":")[1])
                head += b"\r\n"
                if b"application/http" in head.lower():  # the header of HTTP is part of chunk 0
                    while size and (line := f.readline(size)):
                        head, size = head + line, size - len(line)
                        if not line.strip():
                            break
                yield 0, not size, head + (b"\r\n\r\n" if not size else b"")
                number = 0
                while size:
                    data, number = f.read(min(chunk, size)), number + 1
                    size = size - len(data) if data else 0  # a file that ends early ends its record
                    yield number, not size, data + (b"\r\n\r\n" if not size else b"")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record = TaskContext.get().partitionId() << 40
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for number, last, data in stream(path):
                    yield pa.RecordBatch.from_arrays([pa.array([record], pa.int64()), pa.array([number], pa.int32()), pa.array([last]), pa.array([data], pa.binary())], names=["record_no", "chunk_no", "last", "data"])
                    record += last

    return paths.select("path").mapInArrow(run, CHUNKS)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    stored = written(archive(written(spool(pages), "warc-spool")), "warc")
    return read_records(stored).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")


QUERIES = {"op4_warc": op4_warc}
ORACLE_SQL = {}

"""ISO base media containers as columns: nested boxes, sample tables and keyframe byte ranges.

``pack`` stores a payload as 8-bit samples of one audio track; ``inspect`` reads any such container's boxes and sample
tables and returns codec, duration and the byte ranges of keyframes.  Payloads are sliced, never decoded.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._store import written

#: Bytes of a stored frame, frames of a chunk, frames from one keyframe to the next, and 8-bit samples a second.
FRAME, CHUNK_FRAMES, KEY_EVERY, RATE = 1024, 8, 16, 8000
#: Boxes that hold boxes, as the format fixes them; boxes within boxes that a container has at most.
NESTED = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta"}
DEEPEST = 16
#: Tables of a track that are read.
TABLES = {b"mdhd", b"stsd", b"stts", b"stss", b"stsc", b"stsz", b"stco", b"co64"}


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind) + body


def _table(kind: bytes, rows: np.ndarray, width: str = ">u4", lead: bytes = b"") -> bytes:
    return _box(kind, bytes(4), lead, struct.pack(">I", len(rows)), rows.astype(width).tobytes())


def container(payload: bytes) -> bytes:
    """``payload`` (not empty) as one track of raw 8-bit mono samples: ftyp, mdat, then moov with the sample tables."""
    n = len(payload)
    sizes = np.full(-(-n // FRAME), FRAME)
    sizes[-1] = n - FRAME * (len(sizes) - 1)
    head = _box(b"ftyp", b"isom", bytes(4), b"isommp42")
    large = n + 8 >= 1 << 32
    data = (struct.pack(">I4sQ", 1, b"mdat", 16 + n) if large else struct.pack(">I4s", 8 + n, b"mdat")) + payload
    first = len(head) + (16 if large else 8)
    chunks = -(-len(sizes) // CHUNK_FRAMES)
    offsets = first + np.arange(chunks) * CHUNK_FRAMES * FRAME
    last = len(sizes) - CHUNK_FRAMES * (chunks - 1)
    to_chunk = [[1, CHUNK_FRAMES, 1]] * (chunks > 1) + [[chunks, last, 1]] * (chunks == 1 or last != CHUNK_FRAMES)
    to_time = [[len(sizes) - 1, FRAME]] * (len(sizes) > 1) + [[1, int(sizes[-1])]]
    even = bool((sizes == sizes[0]).all())
    tables = _box(
        b"stbl",
        _box(b"stsd", bytes(4), struct.pack(">I", 1), _box(b"raw ", bytes(6), struct.pack(">H8xHHHHI", 1, 1, 8, 0, 0, RATE << 16))),
        _table(b"stts", np.array(to_time)),
        _table(b"stss", np.arange(1, len(sizes) + 1, KEY_EVERY)),
        _table(b"stsc", np.array(to_chunk)),
        _box(b"stsz", bytes(4), struct.pack(">II", int(sizes[0]) if even else 0, len(sizes)), b"" if even else sizes.astype(">u4").tobytes()),
        _table(b"co64", offsets, ">u8") if large else _table(b"stco", offsets),
    )
    matrix = struct.pack(">9I", 1 << 16, 0, 0, 0, 1 << 16, 0, 0, 0, 1 << 30)
    wide = n >= 1 << 32
    span = struct.pack(">QQIQ" if wide else ">IIII", 0, 0, RATE, n)
    track = struct.pack(">QQIIQ" if wide else ">IIIII", 0, 0, 1, 0, n)
    version = bytes([int(wide), 0, 0, 0])
    info = _box(b"minf", _box(b"smhd", bytes(8)), _box(b"dinf", _box(b"dref", bytes(4), struct.pack(">I", 1), _box(b"url ", bytes([0, 0, 0, 1])))), tables)
    media = _box(b"mdia", _box(b"mdhd", version, span, bytes(4)), _box(b"hdlr", bytes(8), b"soun", bytes(13)), info)
    movie = _box(
        b"moov",
        _box(b"mvhd", version, span, struct.pack(">IH10x", 1 << 16, 256), matrix, bytes(24), struct.pack(">I", 2)),
        _box(b"trak", _box(b"tkhd", bytes([int(wide), 0, 0, 3]), track, bytes(12), struct.pack(">HH", 256, 0), matrix, bytes(8)), media),
    )
    return b"".join((head, data, movie))


def boxes(data: memoryview, begin: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """Path, begin and end of the body of every box, nested ones after the box that holds them."""
    open_ = [(begin, end, b"")]
    while open_:
        begin, end, path = open_.pop()
        if begin + 8 > end:
            continue
        size, kind = struct.unpack_from(">I4s", data, begin)
        body = begin + 8
        if size == 1:
            size, body = struct.unpack_from(">Q", data, begin + 8)[0], begin + 16
        stop = end if size == 0 else begin + size
        if stop > end or stop < body or len(open_) >= DEEPEST:
            raise ValueError(f"box {kind!r} at {begin} has a wrong size, or is too deep")
        yield path + b"/" + kind, body, stop
        open_.append((stop, end, path))
        if kind in NESTED:
            open_.append((body, stop, path + b"/" + kind))


def tracks(data: memoryview) -> list[dict]:
    """Codec, timescale, duration and, by sample, offset, size and whether it is a keyframe, for each track.

    ValueError, KeyError, IndexError or struct.error if a table is missing, broken, or tells of more samples or bytes than
    the container has: no table is believed before its size is checked.
    """
    out: list[dict] = []
    for path, a, b in boxes(data, 0, len(data)):
        if path == b"/moov/trak":
            out.append({})
        elif path.startswith(b"/moov/trak/") and (kind := path[-4:]) in TABLES:
            out[-1][kind] = a, b

    def table(where: tuple[int, int], width: int, skip: int = 8, kind: str = ">u4") -> np.ndarray:
        a, b = where
        count = struct.unpack_from(">I", data, a + skip - 4)[0]
        return np.frombuffer(data[a + skip : b], kind, count * width).reshape(count, width).astype(np.int64)

    for t in out:
        a, _ = t[b"mdhd"]
        scale, duration = struct.unpack_from(">IQ" if data[a] else ">II", data, a + (20 if data[a] else 12))
        even, count = struct.unpack_from(">II", data, t[b"stsz"][0] + 4)
        if duration >= 1 << 63 or even * count > len(data):
            raise ValueError("more than the container has")
        sizes = np.full(count, even) if even else table(t[b"stsz"], 1, 12)[:, 0]
        places = table(t[b"stco"], 1)[:, 0] if b"stco" in t else table(t[b"co64"], 1, 8, ">u8")[:, 0]
        runs = table(t[b"stsc"], 3)
        if len(places) and runs[0, 0] != 1:
            raise ValueError("chunks without samples")
        frames = np.repeat(runs[:, 1], np.diff(np.append(runs[:, 0], len(places) + 1))) if len(places) else places  # by chunk
        if frames.sum() != count:
            raise ValueError("tables of chunks and of sizes differ")
        chunk = np.repeat(np.arange(len(places)), frames)
        begun = np.cumsum(sizes) - sizes
        starts = (np.cumsum(frames) - frames)[chunk]
        key = np.zeros(count, bool)
        offset = places[chunk] + begun - begun[starts]
        if count and (offset.min() < 0 or (offset + sizes).max() > len(data)):
            raise ValueError("samples beyond the end")
        numbers = table(t[b"stss"], 1)[:, 0] if b"stss" in t else np.arange(1, count + 1)
        if len(numbers) and numbers.min() < 1:
            raise ValueError("samples are numbered from 1")
        key[numbers - 1] = True
        codec = bytes(data[t[b"stsd"][0] + 12 : t[b"stsd"][0] + 16]).decode("latin-1")
        t |= {"codec": codec, "timescale": scale, "duration": duration, "offset": offset, "size": sizes, "key": key}
    return out


def pack(rows: DataFrame, payload: str = "payload", into: str = "media") -> DataFrame:
    """``rows`` with the container of each payload in ``into``; null and empty payloads give null."""
    rows = rows.drop(into) if into != payload else rows
    schema = T.StructType(list(rows.schema)).add(into, "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                made = [container(x.as_buffer().to_pybytes()) if x.is_valid and len(x.as_buffer()) else None for x in part.column(payload)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, pa.binary())], names=schema.names)

    return rows.mapInArrow(run, schema)


def inspect(rows: DataFrame, media: str = "media", *, payload: bool = False) -> DataFrame:
    """``rows`` with ``codec``, ``timescale``, ``duration``, ``n_samples``, ``key_begins`` and ``key_ends`` of the first
    track, and if asked for its stored bytes in ``payload``.  A container that is null, broken, forged or without tracks, or
    whose samples are in fragments, gives nulls; columns of those names are replaced."""
    fields = {"codec": "string", "timescale": "long", "duration": "long", "n_samples": "long", "key_begins": "array<bigint>", "key_ends": "array<bigint>"} | ({"payload": "binary"} if payload else {})
    rows = rows.drop(*(f for f in [*fields, "payload"] if f != media))
    schema = T.StructType(list(rows.schema))
    for name, kind in fields.items():
        schema = schema.add(name, T.ArrayType(T.LongType()) if "array" in kind else kind)
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()][: len(fields)]

    def one(raw: bytes | None) -> tuple:
        try:
            data = memoryview(raw)
            t = tracks(data)[0]
        except (TypeError, ValueError, IndexError, KeyError, struct.error):
            return (None,) * len(fields)
        if not len(t["offset"]):
            return (t["codec"], t["timescale"], t["duration"], 0, [], [], b"")[: len(fields)]
        begin, end = t["offset"], t["offset"] + t["size"]
        found = t["codec"], t["timescale"], t["duration"], len(begin), begin[t["key"]].tolist(), end[t["key"]].tolist()
        if not payload:
            return found
        joint = np.flatnonzero(np.append(True, begin[1:] != end[:-1]))  # samples that follow each other are read at once
        stops = end[np.append(joint[1:], len(end)) - 1]
        return *found, b"".join(data[a:b] for a, b in zip(begin[joint].tolist(), stops.tolist(), strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                got = [one(x.as_buffer() if x.is_valid else None) for x in part.column(media)]
                columns = [pa.array([g[i] for g in got], kind) for i, kind in enumerate(types)]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=schema.names)

    return rows.mapInArrow(run, schema)


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    raw = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    n = F.octet_length(raw).cast("long")
    missing = F.when(n == 0, 64).otherwise(F.pmod(-n, F.lit(64))).cast("int")
    padded = F.concat(raw, F.encode(F.repeat(F.lit("\0"), missing), "UTF-8"))
    stored = written(pack(docs.select("doc_id", n.alias("n_bytes"), padded.alias("payload"))).drop("payload"), "media")
    rows = inspect(stored, payload=True)
    ranges = F.array_join(F.zip_with("key_begins", "key_ends", lambda a, b: F.concat_ws("-", a.cast("string"), b.cast("string"))), ",")
    feature = F.concat_ws(";", F.concat(F.lit("codec="), F.trim("codec")), *(F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in ("timescale", "duration", "n_samples")), F.concat(F.lit("keys="), ranges))
    size = F.octet_length("payload").cast("long")
    return rows.select(
        "doc_id", "n_bytes", size.alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -64, 64)).alias("tail_crc32"), F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"), feature.alias("feature"),
    )


QUERIES = {"op10_media": op10_media}

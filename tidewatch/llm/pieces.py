"""SentencePiece encoding that keeps byte offsets, and decoding.

Texts are normalised here: at each place the longest prefix in the model's compiled character map is replaced, and
every normalised byte records which original bytes it stands for.  The library then only segments units of normalised
text, which no piece crosses, and the lengths of the pieces project each one to its span of the original bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._text import hashed, utf8
from ._text import pieces as runs

#: The character that stands for a space in pieces; fixed by the model format.
MARK = "▁"
#: Distinct units whose ids a worker keeps.
CACHE_UNITS = 200_000


class CharMap:
    """The compiled character map: a double-array trie from prefixes to places in a string of replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.values = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest prefix of ``text[at:]`` in the map."""
        if not self.units:
            return None
        units, found = self.units, None
        unit = units[0]
        node = (unit >> 10) << ((unit & 512) >> 6)
        for i in range(at, len(text)):
            node ^= text[i]
            unit = units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.values[found[1] : self.values.index(b"\0", found[1])]


class Normaliser:
    """Normalisation as the model's settings say, with the alignment of its output.  A mark is one byte here, a space."""

    def __init__(self, spec):
        self.map = CharMap(spec.precompiled_charsmap)
        self.dummy, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.plain = not self.map.units and not self.squeeze and self.dummy

    def rows(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Normalised bytes of all rows, their offsets, and the place in its row of each byte and of each row's end; None if
        that is one less than in the normalised row, as a prefix is all that is new."""
        raw = data[offsets[0] : offsets[-1]]
        edges = offsets - offsets[0]
        if self.plain and MARK.encode() not in raw.tobytes():
            full = np.diff(edges) > 0
            moved = np.concatenate([[0], np.cumsum(full)])
            return np.insert(raw, edges[:-1][full], 32), edges + moved, None
        out = [self.row(raw[i:j].tobytes()) for i, j in zip(edges, edges[1:], strict=False)]
        sizes = np.array([len(t) for t, _ in out], np.int64)
        where = np.concatenate([w for _, w in out]) if out else np.zeros(0, np.int64)
        return np.frombuffer(b"".join(t for t, _ in out), np.uint8), np.concatenate([[0], np.cumsum(sizes)]), where

    def row(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        out, where, at = bytearray(), [], 0
        while at < len(raw):
            hit = self.map.longest(raw, at)
            n = hit[0] if hit else 1 + (raw[at] >= 0xC0) + (raw[at] >= 0xE0) + (raw[at] >= 0xF0)
            new = (hit[1] if hit else raw[at : at + n]).replace(MARK.encode(), b" ")
            if self.squeeze:
                while new.startswith(b" ") and (not out or out.endswith(b" ")):
                    new = new[1:]
            out += new
            where += [at] * len(new)
            at += n
        if self.squeeze:
            while out.endswith(b" "):
                out.pop()
                at = where.pop()
        if out and self.dummy:
            out[:0] = b" "
            where.insert(0, where[0])
        return bytes(out), np.array([*where, at])


def alike(text: np.ndarray, begin: np.ndarray, end: np.ndarray, other: np.ndarray) -> bool:
    """Whether all stretches of ``text``, which follow each other, have the bytes of those numbered ``other``."""
    size = end - begin
    if (size != size[other]).any():
        return False
    shift = (begin[other] - begin).astype(np.int32 if len(text) < 1 << 31 else np.int64)
    place = np.arange(len(text), dtype=shift.dtype)
    place += np.repeat(shift, size)
    return bool((text[place] == text).all())


class Encoder:
    """A model file as encoder and decoder."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        self.stock = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.end, self.unknown = self.stock.eos_id(), self.stock.unk_id()
        spec = model.normalizer_spec
        if not spec.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models without marks before words aren't supported")
        self.normalise = Normaliser(spec)
        texts = [p.piece for p in model.pieces if p.type != 6]
        # where no piece goes over the start of a run of marks, units from there to the next are segmented one by one, and
        # alike wherever they are; user-defined symbols are matched over the whole text
        self.split = not any(re.search(f"[^{MARK}]{MARK}", t) for t in texts) and all(p.type != 4 for p in model.pieces)
        spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces = b"", False, False, False
        self.bare = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        # bytes of each piece, a mark counting one
        self.size = np.array([1 if self.bare.is_byte(i) else self._bytes(self.bare.id_to_piece(i)) for i in range(self.bare.get_piece_size())])
        self.known: dict[bytes, list[int]] = {}

    @staticmethod
    def _bytes(piece: str) -> int:
        return len(piece.encode()) - 2 * piece.count(MARK)

    def _ids(self, units: list[bytes]) -> list[list[int]]:
        new = [u for u in units if u not in self.known]
        if len(self.known) + len(new) > CACHE_UNITS:
            self.known.clear()
            new = units
        self.known.update(zip(new, self.bare.encode([u.decode().replace(" ", MARK) for u in new], num_threads=1), strict=True))
        return [self.known[u] for u in units]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For the texts in ``data``: offsets of the rows' ids, ids with the end id, and begin and end of each in its text."""
        text, edges, where = self.normalise.rows(data, offsets)
        n = len(edges) - 1
        sizes = np.diff(edges)
        space = text == 32
        starts = np.zeros(len(text), bool)
        if self.split and len(text):
            starts[1:] = space[1:] & ~space[:-1]
        starts[edges[:-1][sizes > 0]] = True
        begin = np.flatnonzero(starts)
        end = np.append(begin[1:], len(text))[: len(begin)]
        row = np.searchsorted(edges, begin, "right") - 1
        # each distinct unit is segmented once; units of one hash are held against its first, byte by byte
        _, one, kind = np.unique(hashed(text, begin, end), return_index=True, return_inverse=True)
        raw = text.tobytes()
        if not alike(text, begin, end, one[kind]):
            number: dict[bytes, int] = {}
            kind = np.array([number.setdefault(raw[i:j], len(number)) for i, j in zip(begin.tolist(), end.tolist(), strict=True)])
            one = np.unique(kind, return_index=True)[1]
        lists = self._ids([raw[i:j] for i, j in zip(begin[one].tolist(), end[one].tolist(), strict=True)])
        count = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter((i for x in lists for i in x), np.int32, int(count.sum()))
        size = self.size[flat]
        place = np.cumsum(count) - count
        for k in np.unique(np.repeat(np.arange(len(lists)), count)[flat == self.unknown]).tolist():
            unit = raw[begin[one[k]] : end[one[k]]].decode().replace(" ", MARK)
            size[place[k] : place[k] + count[k]] = [self._bytes(p) if i == self.unknown else self.size[i] for i, p in zip(lists[k], self.bare.encode(unit, out_type=str), strict=True)]
        # of every unit, the ids of its kind; then an end id for each row
        own = count[kind]
        at = np.repeat(place[kind] - (np.cumsum(own) - own), own) + np.arange(own.sum())
        id_row = np.repeat(row, own)
        per_row = np.bincount(id_row, minlength=n)
        out_offsets = np.concatenate([[0], np.cumsum(per_row + 1)])
        last = out_offsets[1:] - 1
        ids = np.full(out_offsets[-1], self.end, np.int32)
        inner = np.ones(len(ids), bool)
        inner[last] = False
        ids[inner] = flat[at]
        stop = np.zeros(len(ids), np.int64)
        stop[inner] = np.cumsum(size[at]) - edges[id_row]  # in the normalised row
        if where is None:
            stop[inner] -= 1
            np.maximum(stop, 0, out=stop)
        else:
            stop[inner] = where[stop[inner] + (edges[:-1] + np.arange(n))[id_row]]
        stop[last] = np.diff(offsets)
        start = np.zeros(len(ids), np.int64)
        start[1:] = stop[:-1]
        start[out_offsets[:-1]] = 0
        start[last] = stop[last]
        return out_offsets.astype(np.int32), ids, start.astype(np.int32), stop.astype(np.int32)

    def texts(self, edges: np.ndarray, ids: np.ndarray) -> pa.Array:
        """The text of each row's ids; some rows at a time become lists."""
        out = []
        for a in range(0, len(edges) - 1, 200):
            rows = edges[a : a + 201].tolist()
            flat = ids[rows[0] : rows[-1]].tolist()
            out.append(pa.array(self.stock.decode([flat[i - rows[0] : j - rows[0]] for i, j in zip(rows, rows[1:], strict=False)], num_threads=1), pa.string()))
        return pa.concat_arrays(out) if out else pa.array([], pa.string())


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, model: str, *, spans: bool = True, decoded: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (with the end id, without sampling) and, if asked for, ``begins`` and ``ends``, the byte
    span of the original text for each id, and ``decoded``, the library's text for the ids, as ``decode`` gives it: in the
    same pass, so that a task has one Python worker with one model.

    A null text encodes as an empty one: the end id alone.  Texts are encoded whole.  The spans follow each other and
    cover the text up to bytes the normaliser drops; byte pieces have one byte each; the end id's span is empty.
    Other columns pass through; columns of those names are replaced.  ``model`` is read on the executors.
    """
    names = ["ids", "begins", "ends"] if spans else ["ids"]
    docs = docs.drop("ids", "begins", "ends", *(["decoded"] if decoded else []))
    schema = T.StructType(list(docs.schema))
    for n in names:
        schema = schema.add(n, T.ArrayType(T.IntegerType()))
    if decoded:
        schema = schema.add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(model)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in runs(offsets):
                edges, *values = e.encode(data, offsets[a : b + 1])
                lists = [pa.ListArray.from_arrays(pa.array(edges), pa.array(v)) for v in values[: len(names)]]
                if decoded:
                    lists.append(e.texts(edges, values[0]))
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, *lists], names=schema.names)

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, model: str) -> DataFrame:
    """``rows`` with ``decoded``, the library's text for ``ids``; null ids decode as an empty text."""
    rows = rows.drop("decoded")
    schema = T.StructType(list(rows.schema)).add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(model)
        for batch in batches:
            lists = batch.column("ids")
            edges = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())])
            yield pa.RecordBatch.from_arrays([*batch.columns, e.texts(edges, lists.flatten().to_numpy())], names=schema.names)

    return rows.mapInArrow(run, schema)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = encode(docs, model_path(), decoded=True)
    spanned = (F.element_at("ends", -1) - F.element_at("begins", 1)).cast("long").alias("spanned_bytes")
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"), spanned,
    )


QUERIES = {"op3_sentencepiece": op3_sentencepiece}

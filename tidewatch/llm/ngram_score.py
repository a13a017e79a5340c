"""Language-model scoring from a log-frequency Bloom filter.

Counts of unigrams and bigrams are quantised on a logarithmic scale; an n-gram of level q is in the filter at each of
the levels up to q, and its level is read back by probing one level after the other until one is missing.

The filter has two parts.  The head has the n-grams from a level on, chosen so that it is within a fixed size, and is
broadcast.  The rest is cut into segments by n-gram, as many as the training text needs, each built where its counts are
merged; what the head doesn't know is looked up where the segments are, so nothing that grows with the corpus is sent to
all workers.  Frequent n-grams are in the head, so no segment is asked much more often than others.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import written
from ._text import mix, pieces, utf8, words

#: Bytes of the head and of the unigrams' rest that are broadcast at most; exact counts of tokens that are.
HEAD_BYTES, NEAR_BYTES, HOT_TOKENS = 64 << 20, 32 << 20, 1_000_000
#: Hash functions of an entry, bits for each (half of them end up set), ratio of a level's counts to those of the one before.
HASHES, BITS, RATIO = 6, 6 / np.log(2), 1.5
#: Bytes of training text for each segment, so that a segment has a few million n-grams at most; parts of the head.
SEGMENT_TEXT, HEAD_PARTS = 16 << 20, 64
#: Groups that documents pass through the segments' tasks in.
SPREAD = 4096
#: Distinct n-grams, and questions, that a task holds before it passes them on.
HELD, HELD_ASKED = 3_000_000, 1_000_000
#: Pseudo-count of the unigrams in a context's distribution.
PRIOR = 2.0
#: Tokens besides the words: the end of a text, and what stands before its first word.
END, BEGIN = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
#: Kinds of rows: of a document, of either n-gram, and questions for exact counts.
DOCUMENT, UNIGRAM, BIGRAM, EXACT = -1, 0, 1, 2
#: Levels that aren't: of the context before the first word, and one that is still to be looked up.
MOST_LEVELS, AT_BEGIN, OPEN = 100, 254, 255

_LEVELS = np.ceil(RATIO ** np.arange(MOST_LEVELS) - 1e-9)


def level(count: np.ndarray) -> np.ndarray:
    """The level of a count of at least 1."""
    return np.searchsorted(_LEVELS, count, "right")


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and the previous token's hash of all tokens: the words of each row, then one end."""
    row, _, _, h = words(data, offsets)
    n = len(offsets) - 1
    last = np.searchsorted(row, np.arange(n), "right")
    h = np.insert(h, last, END)
    row = np.insert(row, last, np.arange(n))
    before = np.empty(len(h), np.uint64)
    before[1:] = h[:-1]
    before[np.flatnonzero(np.append(True, row[1:] != row[:-1]))] = BEGIN
    return row, h, before


def bigram_key(before: np.ndarray, h: np.ndarray) -> np.ndarray:
    return mix(before ^ np.uint64(0x9E3779B97F4A7C15)) + h


def _scaled(x: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash as a number under ``size``, which is under 2 ** 32, without a division."""
    return (x >> np.uint64(32)) * size >> np.uint64(32)


def placed(keys: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment of each n-gram and its mark there, 32 bits of its hash."""
    x = mix(keys)
    return _scaled(x, np.uint64(segments)).astype(np.int64), x & np.uint64(0xFFFFFFFF)


def _probes(marks: np.ndarray, at_level: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the probes of a level begin, and the step from one to the next."""
    x = mix(marks + np.uint64(at_level * 0x9E3779B97F4A7C15 % (1 << 64)))
    return x, (x << np.uint64(32)) | np.uint64(1 << 31 | 1)


def _hashes(at_level: int, first: int) -> int:
    """Twice as many at the least level of a head, as what passes there by chance would count as frequent."""
    return HASHES * (1 + (at_level == first > 1))


class Filter:
    """Bits of one kind of n-gram for levels from ``first`` on, in parts: (part, sizes in bits by level, bits by level)."""

    def __init__(self, parts: int, first: int, rows: list[tuple[int, list[int], list[bytes]]]):
        self.first, self.at = first, []
        for i in range(max((len(sizes) for _, sizes, _ in rows), default=0)):
            size, bits = np.zeros(parts, np.uint64), [b""] * parts
            for part, sizes, own in rows:
                if i < len(sizes):
                    size[part], bits[part] = sizes[i], own[i]
            self.at.append((np.cumsum(size) - size, size, np.frombuffer(b"".join(bits) or b"\0", np.uint8)))

    def levels(self, part: np.ndarray, marks: np.ndarray) -> np.ndarray:
        out = np.zeros(len(marks), np.uint8)
        alive = np.arange(len(marks))
        for i, (bases, sizes, bits) in enumerate(self.at):
            alive = alive[sizes[part[alive]] > 0]
            if not len(alive):
                break
            base, size = bases[part[alive]], sizes[part[alive]]
            x, step = _probes(marks[alive], self.first + i)
            for _ in range(_hashes(self.first + i, self.first)):
                at = base + _scaled(x, size)
                found = np.flatnonzero(bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1))
                alive, base, size, x, step = alive[found], base[found], size[found], x[found], step[found]
                x = x + step
            out[alive] = self.first + i
        return out


def build(marks: np.ndarray, levels: np.ndarray, first: int) -> tuple[list[int], list[bytes]]:
    """Sizes in bits, and the bits, of a part for each level from ``first`` to the highest."""
    sizes, bits = [], []
    for q in range(first, int(levels.max(initial=0)) + 1):
        own = marks[levels >= q]
        hashes = _hashes(q, first)
        size = 8 * math.ceil(max(1, BITS * hashes / HASHES * len(own)) / 8)
        flags = np.zeros(size, bool)
        x, step = _probes(own, q)
        for _ in range(hashes):
            flags[_scaled(x, np.uint64(size))] = True
            x = x + step
        sizes.append(size)
        bits.append(np.packbits(flags, bitorder="little").tobytes())
    return sizes, bits


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _dealt(kind: int, segment: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, int, list[bytes]]]:
    """Kind, segment and the columns' bytes for each segment that has entries; their order stays."""
    order = np.argsort(segment, kind="stable")
    segment, columns = segment[order], [c[order] for c in columns]
    edges = [0, *(np.flatnonzero(segment[1:] != segment[:-1]) + 1).tolist(), len(segment)]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield kind, int(segment[a]), [c[a:b].tobytes() for c in columns]


_BLOCK = "kind int, segment int, cols array<binary>"


def _blocks(rows: Iterator[tuple[int, int, list[bytes]]]) -> Iterator[pa.RecordBatch]:
    rows = list(rows)
    if rows:
        columns = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.list_(pa.binary())), strict=True)], names=["kind", "segment", "cols"])


def _counted(docs: DataFrame, segments: int) -> DataFrame:
    """Blocks of n-gram counts, a row for each task, kind and segment, with a few more for tasks of much text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {UNIGRAM: [], BIGRAM: []}

        def passed(kind: int) -> Iterator[pa.RecordBatch]:
            if held[kind]:
                keys, counts = _joined(held[kind])
                held[kind] = []
                yield from _blocks(_dealt(kind, placed(keys, segments)[0], [keys, counts.astype(np.int64)]))

        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in pieces(offsets):
                _, h, before = tokens(data, offsets[a : b + 1])
                for kind, keys in ((UNIGRAM, h), (BIGRAM, bigram_key(before, h))):
                    held[kind].append(_summed(keys, np.ones(len(keys), np.int32)))
                    if sum(len(k) for k, _ in held[kind]) > HELD:
                        yield from passed(kind)
        for kind in (UNIGRAM, BIGRAM):
            yield from passed(kind)

    return docs.select(F.col("text").cast("string")).mapInArrow(run, _BLOCK)


def _joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return _summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[list[pa.Buffer]]]]:
    """Kind, segment and the blocks of each, which follow each other."""
    at, blocks = None, []
    for batch in batches:
        for place, cols in zip(zip(batch.column("kind").to_pylist(), batch.column("segment").to_pylist(), strict=True), batch.column("cols"), strict=True):
            if place != at:
                if blocks:
                    yield *at, blocks
                at, blocks = place, []
            blocks.append([c.as_buffer() for c in cols.values])
    if blocks:
        yield *at, blocks


_SEGMENT = {
    "kind": pa.int32(), "segment": pa.int32(), "total": pa.int64(), "at_level": pa.list_(pa.int64()), "of_level": pa.list_(pa.float64()), "keys": pa.binary(), "counts": pa.binary(),
    "sizes": pa.list_(pa.int64()), "bits": pa.list_(pa.binary()),
}
_SEGMENT_DDL = "kind int, segment int, total long, at_level array<bigint>, of_level array<double>, keys binary, counts binary, sizes array<bigint>, bits array<binary>"


def _merged(blocks: DataFrame, segments: int) -> DataFrame:
    """A row for each kind and segment: the sum of its counts, entries and sum of counts by level, the filter's bits by level,
    and ``keys`` and ``counts``: all of the unigrams', the bigrams' from level 2 on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, segment, parts in _groups(batches):
            keys, counts = _joined([(np.frombuffer(k, np.uint64), np.frombuffer(c, np.int64)) for k, c in parts])
            levels = level(counts)
            sizes, bits = build(placed(keys, segments)[1], levels, 1)
            told = levels >= (2 if kind == BIGRAM else 1)
            own = [kind, segment, int(counts.sum()), np.bincount(levels, minlength=MOST_LEVELS + 1), np.bincount(levels, counts, MOST_LEVELS + 1), keys[told].tobytes(), counts[told].tobytes(), sizes, bits]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(own, _SEGMENT.values(), strict=True)], names=list(_SEGMENT))

    return blocks.repartition("kind", "segment").sortWithinPartitions("kind", "segment").mapInArrow(run, _SEGMENT_DDL)


def _gathered(rows: DataFrame, parts: int, first: int) -> Filter:
    """A filter on the driver, from ``rows(segment, sizes, bits)`` of a bounded size; bits are copied once."""
    t = rows.select("segment", "sizes", "bits").toArrow()
    bits = ([b.as_buffer() for b in x.values] for x in t.column("bits"))
    return Filter(parts, first, list(zip(t.column("segment").to_pylist(), t.column("sizes").to_pylist(), bits, strict=True)))


class Model:
    """The tables of a model learned from ``docs(text)``, and what is small enough for the driver; null texts are empty."""

    def __init__(self, docs: DataFrame, head_bytes: int = HEAD_BYTES):
        self.docs, size = docs.agg(F.count("*"), F.sum(F.octet_length(F.col("text").cast("string")))).first()
        self.segments = max(16, math.ceil((size or 0) / SEGMENT_TEXT))
        self.table = written(_merged(_counted(docs, self.segments), self.segments), "ngram-segments")
        self.total = self.table.where(f"kind = {UNIGRAM}").agg(F.sum("total")).first()[0] or 0
        #: Entries, and the mean of their counts, by kind and level; 0 for level 0.
        self.entries, self.counts = np.zeros((2, 256)), np.zeros((2, 256))
        by_level = self.table.select("kind", F.posexplode(F.arrays_zip("at_level", "of_level")).alias("level", "x")).groupBy("kind", "level")
        for r in by_level.agg(F.sum("x.at_level").alias("n"), F.sum("x.of_level").alias("of")).where("n > 0").collect():
            self.entries[r["kind"], r["level"]], self.counts[r["kind"], r["level"]] = r["n"], r["of"] / r["n"]
        self.distinct = int(self.entries[UNIGRAM].sum())
        #: The least level of the head, by kind: what takes more room begins later, until both are within the size.
        self.first = [2, 2]
        while sum(sizes := [self._head_bytes(k) for k in (UNIGRAM, BIGRAM)]) > head_bytes:
            self.first[int(sizes[1] >= sizes[0])] += 1
        #: The least level of tokens whose exact counts are broadcast.
        self.hot_from = next(q for q in range(1, MOST_LEVELS + 2) if self.entries[UNIGRAM, q:].sum() <= HOT_TOKENS)

    def _head_bytes(self, kind: int) -> float:
        first = self.first[kind]
        return BITS / 8 * sum((q - first + 1 + (first > 1)) * self.entries[kind, q] for q in range(first, MOST_LEVELS + 1))

    def near_bytes(self) -> float:
        """Bytes of the unigrams' filter under the head's levels."""
        return BITS / 8 * sum(min(q, self.first[UNIGRAM] - 1) * self.entries[UNIGRAM, q] for q in range(1, MOST_LEVELS + 1))

    def heads(self) -> list[Filter]:
        """The head by kind, built in tasks."""
        first = self.first

        def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for kind, keys, counts in zip(batch.column("kind").to_pylist(), batch.column("keys"), batch.column("counts"), strict=True):
                    keys, q = np.frombuffer(keys.as_buffer(), np.uint64), level(np.frombuffer(counts.as_buffer(), np.int64))
                    part, mark = placed(keys[q >= first[kind]], HEAD_PARTS)
                    yield from _blocks(_dealt(kind, part, [mark.astype(np.uint32), q[q >= first[kind]].astype(np.uint8)]))

        def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for kind, part, blocks in _groups(batches):
                marks = np.concatenate([np.frombuffer(m, np.uint32) for m, _ in blocks]).astype(np.uint64)
                sizes, bits = build(marks, np.concatenate([np.frombuffer(q, np.uint8) for _, q in blocks]), first[kind])
                yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([part], pa.int32()), pa.array([sizes], pa.list_(pa.int64())), pa.array([bits], pa.list_(pa.binary()))], names=["kind", "segment", "sizes", "bits"])

        def gathered(kind: int) -> Filter:
            own = self.table.where(F.col("kind") == kind).select("kind", "keys", "counts").mapInArrow(chosen, _BLOCK)
            own = own.repartition("kind", "segment").sortWithinPartitions("kind", "segment")
            return _gathered(own.mapInArrow(built, "kind int, segment int, sizes array<bigint>, bits array<binary>"), HEAD_PARTS, first[kind])

        return [gathered(UNIGRAM), gathered(BIGRAM)]

    def rest(self, kind: int) -> DataFrame:
        """The segments of a kind with the bits of the levels under the head's, exact counts of the unigrams with them."""
        n = self.first[kind] - 1
        counted = ["keys", "counts"] if kind == UNIGRAM else []
        return self.table.where(F.col("kind") == kind).select("kind", "segment", F.slice("sizes", 1, n).alias("sizes"), F.slice("bits", 1, n).alias("bits"), *counted)

    def hot(self) -> tuple[np.ndarray, np.ndarray]:
        """The most frequent tokens, sorted, and their counts: at most ``HOT_TOKENS``."""
        least = self.hot_from

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for keys, counts in zip(batch.column("keys"), batch.column("counts"), strict=True):
                    k, c = np.frombuffer(keys.as_buffer(), np.uint64), np.frombuffer(counts.as_buffer(), np.int64)
                    some = level(c) >= least
                    yield pa.RecordBatch.from_arrays([pa.array(k[some].view(np.int64)), pa.array(c[some])], names=["key", "count"])

        t = self.table.where(f"kind = {UNIGRAM}").select("keys", "counts").mapInArrow(run, "key long, count long").toArrow()
        keys, counts = t.column("key").to_numpy().view(np.uint64), t.column("count").to_numpy()
        order = np.argsort(keys)
        return keys[order], counts[order]

    def log_probability(self) -> Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
        """log10 of the probability of tokens, from the levels of token, context and bigram: the bigram's count and a share of
        the unigram's probability, over the context's count."""
        u, two = self.counts[UNIGRAM].copy(), self.counts[BIGRAM].copy()
        p = PRIOR * (u + 0.5) / (self.total + 0.5 * (self.distinct + 1))
        u[AT_BEGIN] = self.docs
        return lambda uq, cq, bq: np.log10((np.minimum(two[bq], u[cq]) + p[uq]) / (u[cq] + PRIOR))


#: What a question has: row, 32 bits and segment of the bigram, token, token before, levels of token, context and bigram.
_ASKED = {"row": np.int64, "mark": np.uint32, "place": np.uint32, "token": np.uint64, "context": np.uint64, "uq": np.uint8, "cq": np.uint8, "bq": np.uint8}


def _questions(kind: int, segment: np.ndarray, asked: dict[str, np.ndarray], names: list[str]) -> Iterator[tuple[int, int, list[bytes]]]:
    """Blocks of questions; rows are stored as the first one and steps from one to the next."""
    for kind, s, cols in _dealt(kind, segment, [asked[n].astype(_ASKED[n], copy=False) for n in names]):
        row = np.frombuffer(cols[0], np.int64)
        yield kind, s, [row[:1].tobytes() + np.diff(row).astype(np.uint32).tobytes(), *cols[1:]]


def _answers(cols: list[pa.Buffer], names: list[str]) -> dict[str, np.ndarray]:
    raw = cols[0]
    out = {"row": np.cumsum(np.concatenate([np.frombuffer(raw[:8], np.int64), np.frombuffer(raw[8:], np.uint32)]))}
    return out | {n: np.frombuffer(c, _ASKED[n]) for n, c in zip(names[1:], cols[1:], strict=True)}


def score(docs: DataFrame, model: Model, near_bytes: int = NEAR_BYTES) -> DataFrame:
    """``docs`` with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Texts are scored whole; a null text is empty and has the end as its one token.  ``base_score`` is exact: counts of the
    most frequent tokens are broadcast, others looked up in their segments.  Columns of those names are replaced; other
    columns pass through, their names must not begin with ``_ngram``.  ``docs`` has to be read from a table, so that its
    rows have the same order if a task runs again.  ``near_bytes`` bounds what is broadcast of the unigrams beside the head;
    beyond it they are looked up in their segments, to the same scores.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_tokens", "n_known", "train_tokens", "base_score", "score")
    others = [c for c in docs.columns if c != "text"]
    segments, log_p = model.segments, model.log_probability()
    near = model.near_bytes() <= near_bytes
    low = _gathered(model.rest(UNIGRAM), segments, 1) if near else None
    shared = spark.sparkContext.broadcast((*model.hot(), *model.heads(), low))
    names = ["row", "mark", "uq", "cq"] if near else list(_ASKED)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    sums, place = ["n_tokens", "_ngram_known", "_ngram_base", "score"], ["_ngram_kind", "_ngram_segment", "_ngram_cols"]
    own_ddl = f"{kinds + ', ' if kinds else ''}_ngram_row long, n_tokens long, _ngram_known long, _ngram_base double, score double"

    def unnamed(schema: pa.Schema, columns: list) -> pa.RecordBatch:
        """Sums for documents that are told by their row number alone."""
        kept = [pa.nulls(len(columns[0]), schema.field(c).type) for c in others]
        return pa.RecordBatch.from_arrays([*kept, *columns], names=[*others, "_ngram_row", *sums])

    def of_documents(rows: pa.RecordBatch) -> pa.RecordBatch:
        n, row = len(rows), rows.column("_ngram_row").to_numpy()
        more = [pa.array(np.full(n, DOCUMENT, np.int32)), pa.array((row % SPREAD).astype(np.int32)), pa.nulls(n, pa.list_(pa.binary()))]
        return pa.RecordBatch.from_arrays([*rows.columns, *more], names=[*rows.schema.names, *place])

    def of_blocks(schema: pa.Schema, blocks: Iterator[tuple[int, int, list[bytes]]]) -> Iterator[pa.RecordBatch]:
        for x in _blocks(blocks):
            rows = unnamed(schema, [pa.nulls(len(x), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())])
            yield pa.RecordBatch.from_arrays([*rows.columns, *x.columns], names=[*rows.schema.names, *place])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        hot, hot_counts, *heads, low = shared.value
        held: list[dict[str, np.ndarray]] = []
        exact: list[tuple[np.ndarray, np.ndarray]] = []

        def passed(schema: pa.Schema) -> Iterator[pa.RecordBatch]:
            if held:
                asked = {n: np.concatenate([x[n] for x in held]) for n in held[0]}
                first = asked["place"].astype(np.int64) if near else placed(asked["token"], segments)[0]
                yield from of_blocks(schema, _questions(BIGRAM if near else UNIGRAM, first, asked, names))
                asked = {"row": np.concatenate([r for r, _ in exact]), "token": np.concatenate([t for _, t in exact])}
                yield from of_blocks(schema, _questions(EXACT, placed(asked["token"], segments)[0], asked, ["row", "token"]))
            held.clear()
            exact.clear()

        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in pieces(offsets):
                n = b - a
                row, h, before = tokens(data, offsets[a : b + 1])
                token, back = np.unique(h, return_inverse=True)
                at = np.minimum(np.searchsorted(hot, token), max(0, len(hot) - 1))
                known = hot[at] == token if len(hot) else np.zeros(len(token), bool)
                base = np.bincount(row, np.where(known, np.log10((hot_counts[at] if len(hot) else at) + 0.5), 0.0)[back], n)
                known = known[back]
                exact.append((number + row[~known], h[~known]))
                uq = heads[UNIGRAM].levels(*placed(token, HEAD_PARTS))
                unknown = np.flatnonzero(uq == 0)
                uq[unknown] = low.levels(*placed(token[unknown], segments)) if near else OPEN
                uq = uq[back]
                cq = np.append(np.uint8(AT_BEGIN), uq[:-1])
                cq[before == BEGIN] = AT_BEGIN
                key, back = np.unique(bigram_key(before, h), return_inverse=True)
                bq = heads[BIGRAM].levels(*placed(key, HEAD_PARTS))[back]
                done = (bq > 0) & (uq != OPEN) & (cq != OPEN)
                s = np.bincount(row[done], log_p(uq[done], cq[done], bq[done]), n)
                place, mark = (x[back][~done] for x in placed(key, segments))
                held.append({"row": number + row[~done], "mark": mark, "place": place, "token": h[~done], "context": before[~done], "uq": uq[~done], "cq": cq[~done], "bq": bq[~done]})
                own = [pa.array(x) for x in (np.arange(number, number + n), np.bincount(row, minlength=n), np.bincount(row[known], minlength=n), base.astype(float), s.astype(float))]
                yield of_documents(pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, n) for c in others), *own], names=[*others, "_ngram_row", *sums]))
                number += n
                if sum(len(x["row"]) for x in held) > HELD_ASKED:
                    yield from passed(batch.schema)
        if held:
            yield from passed(batch.schema)

    def at_segments(stream: DataFrame, rest: DataFrame, answer, ddl: str) -> DataFrame:
        """``answer`` to the questions that are dealt to each segment, which is there before them; documents pass through."""
        rest = rest.withColumnsRenamed({c: f"_ngram_{c}" for c in rest.columns})
        facts = [c for c in rest.columns if c not in place]
        rows = stream.unionByName(rest, allowMissingColumns=True).repartition("_ngram_kind", "_ngram_segment")
        rows = rows.sortWithinPartitions("_ngram_kind", "_ngram_segment", F.col("_ngram_cols").isNotNull())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, held = None, {}
            for batch in batches:
                kind = batch.column("_ngram_kind").to_numpy()
                if n := int(np.searchsorted(kind, DOCUMENT, "right")):
                    yield from answer(batch.schema, DOCUMENT, {}, batch.slice(0, n).select([*others, "_ngram_row", *sums]))
                for i, segment in enumerate(batch.column("_ngram_segment").to_pylist()[n:], n):
                    here, cols = (int(kind[i]), segment), batch.column("_ngram_cols")[i]
                    if not cols.is_valid:
                        at, held = here, {c.removeprefix("_ngram_"): batch.column(c)[i] for c in facts}
                    else:
                        yield from answer(batch.schema, here[0], held if at == here else {}, [c.as_buffer() for c in cols.values])

        return rows.mapInArrow(run, ddl)

    def low_levels(held: dict, marks: np.ndarray) -> np.ndarray:
        return Filter(1, 1, [(0, held["sizes"].as_py(), held["bits"].as_py())] if held else []).levels(np.zeros(len(marks), np.int64), marks.astype(np.uint64))

    joint_ddl = f"{own_ddl}, _ngram_kind int, _ngram_segment int, _ngram_cols array<binary>"

    def filled(which: str, then: str):
        """Fills in the level of a token and deals the questions to the segments that come next."""

        def answer(schema: pa.Schema, kind: int, held: dict, x) -> Iterator[pa.RecordBatch]:
            if kind == DOCUMENT:
                yield of_documents(x)
            elif kind == EXACT:  # answered at the end
                yield from of_blocks(schema, [(EXACT, int(placed(_answers(x, ["row", "token"])["token"][:1], segments)[0][0]), [c.to_pybytes() for c in x])])
            else:
                asked = _answers(x, names)
                level_, token = ("uq", "token") if which == "token" else ("cq", "context")
                q = asked[level_].copy()
                some = np.flatnonzero(q == OPEN)
                q[some] = low_levels(held, placed(asked[token][some], segments)[1])
                asked[level_] = q
                to = asked["place"].astype(np.int64) if then == "bigram" else placed(asked[then], segments)[0]
                yield from of_blocks(schema, _questions(BIGRAM if then == "bigram" else UNIGRAM, to, asked, names))

        return answer

    def answered(schema: pa.Schema, kind: int, held: dict, x) -> Iterator[pa.RecordBatch]:
        if kind == DOCUMENT:
            yield x
            return
        asked = _answers(x, names if kind == BIGRAM else ["row", "token"])
        row, back = np.unique(asked["row"], return_inverse=True)
        known, base, s = np.zeros(len(row), np.int64), np.zeros(len(row)), np.zeros(len(row))
        if kind == BIGRAM:
            bq = asked["bq"].copy() if "bq" in asked else np.zeros(len(back), np.uint8)
            some = np.flatnonzero(bq == 0)
            bq[some] = low_levels(held, asked["mark"][some])
            s = np.bincount(back, log_p(asked["uq"], asked["cq"], bq), len(row))
        else:
            keys, counts = (np.frombuffer(held[c].as_buffer(), t) if held else np.zeros(0, t) for c, t in (("keys", np.uint64), ("counts", np.int64)))
            at = np.minimum(np.searchsorted(keys, asked["token"]), max(0, len(keys) - 1))
            count = np.where(keys[at] == asked["token"], counts[at], 0) if len(keys) else np.zeros(len(at), np.int64)
            known, base = np.bincount(back, count > 0, len(row)).astype(np.int64), np.bincount(back, np.log10(count + 0.5), len(row))
        yield unnamed(schema, [pa.array(row), pa.nulls(len(row), pa.int64()), pa.array(known), pa.array(base.astype(float)), pa.array(s.astype(float))])

    out = docs.mapInArrow(ask, joint_ddl)
    if not near:
        for which, then in (("token", "context"), ("context", "bigram")):
            out = at_segments(out, model.rest(UNIGRAM).drop("keys", "counts"), filled(which, then), joint_ddl)
    exact_rows = model.rest(UNIGRAM).select(F.lit(EXACT).alias("kind"), "segment", "keys", "counts")
    out = at_segments(out, model.rest(BIGRAM).unionByName(exact_rows, allowMissingColumns=True), answered, own_ddl)
    out = out.groupBy("_ngram_row").agg(*(F.first(c, ignorenulls=True).alias(c) for c in others), *(F.sum(c).alias(c) for c in sums))
    all_mass = float(np.log10(model.total + 0.5 * (model.distinct + 1)))
    return out.select(
        *others, "n_tokens", F.col("_ngram_known").alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("_ngram_base") - F.col("n_tokens") * all_mass).alias("base_score"), "score",
    )


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False)))
    out = score(docs, Model(docs.where(~F.col("held_out")).select("text")))
    # what the context of a token adds to its own frequency: high where the corpus has a text more than once
    return out.withColumn("gain_per_token", (F.col("score") - F.col("base_score")) / F.col("n_tokens"))


QUERIES = {"op2_lm_score": op2_lm_score}

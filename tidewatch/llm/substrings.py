"""Repeated passages by content-defined chunks.

A gear hash rolls over the bytes of a text; a cut is where it is least among its neighbours, so cuts depend on the
content nearby alone and an insertion moves only those next to it.  Chunks run from word to word; those whose words
have the same digest are the same.  A run of chunks that are earlier in the corpus is the core of a repeated passage;
its ends are moved outwards word by word as far as the text is that of the first occurrence, and what is long enough
then is a passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._store import written
from ._text import LOWER, SPACE, mix, pieces, runs_hashed, utf8, words

#: Bytes that a hash covers; bytes on either side among which a cut is least, so a chunk has about twice as many.
GEAR_BYTES, RADIUS = 16, 24
#: A chunk without a cut ends after so many words.
MOST_WORDS = 512
#: Words that make a passage; the sentences that many documents share are shorter.
LEAST_WORDS = 51
#: Bytes beyond an end of a run of chunks that are read first.  What chunks miss of a passage is less, as a rule: a chunk that
#: reaches beyond it, and one whose cut depends on what is beyond it.  Where all of them agree, so many times more are read.
REACH, FARTHER = 192, 8
#: Ends that are looked up by a broadcast of their places; more are dealt out with the texts.
FEW = 2_000_000

_PLAIN = np.where(SPACE, 32, LOWER).astype(np.uint8)
_GEAR = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint32)


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places of ``data``, sorted, where the gear hash is least among its neighbours in the same row; equal ones are all
    least, so that text which repeats itself at once is cut at each turn.  Runs of white space count as one space."""
    base = int(offsets[0])
    edges = offsets - base
    if not edges[-1]:
        return np.zeros(0, np.int64)
    text = _PLAIN[data[base : base + int(edges[-1])]]
    keep = np.ones(len(text), bool)
    keep[1:] = (text[1:] != 32) | (text[:-1] != 32)
    keep[edges[:-1][edges[:-1] < len(text)]] = True
    kept = np.flatnonzero(keep)
    text, edges = text[kept], np.searchsorted(kept, edges)
    n, gap = len(text), GEAR_BYTES + RADIUS
    # rows are set apart, so that no hash and no comparison reaches from one to another
    place = np.arange(n) + np.repeat(np.arange(1, len(edges)) * gap, np.diff(edges))
    h = np.zeros(n + len(edges) * gap, np.uint32)
    h[place] = _GEAR[text]
    span = 1
    while span < GEAR_BYTES:  # sums over twice as many bytes from those over as many
        h[span:] = h[span:] + (h[:-span] << np.uint32(2 * span))
        span *= 2
    value = np.full(len(h), 0xFFFFFFFF, np.uint32)
    value[place] = (h[place] * np.uint32(0x9E3779B1)) ^ (h[place] >> np.uint32(15))
    low, span = value.copy(), 1
    while 2 * span <= RADIUS:  # least of [i, i + span)
        low[: len(low) - span] = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    ahead = np.minimum(low[place + 1], low[place + 1 + RADIUS - span])
    behind = np.minimum(low[place - RADIUS], low[place - span])
    return kept[(value[place] <= behind) & (value[place] <= ahead)] + base


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of all chunks in order: row, begin and end in ``data``, words, digest.  A chunk begins with the first word that begins
    at a cut or after it."""
    row, begin, end, h = words(data, offsets)
    if not len(row):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64))
    starts = np.zeros(len(row), bool)
    at = np.searchsorted(begin, cuts(data, offsets))
    starts[at[at < len(row)]] = True
    starts[np.flatnonzero(np.append(True, row[1:] != row[:-1]))] = True
    first = np.flatnonzero(starts)
    size = np.diff(np.append(first, len(row)))
    if size.max() > MOST_WORDS:
        parts = -(-size // MOST_WORDS)
        inner = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first = np.repeat(first, parts) + inner * MOST_WORDS
        size = np.diff(np.append(first, len(row)))
    return row[first], begin[first], end[first + size - 1], size, runs_hashed(h, first, size)


def chunked(docs: DataFrame) -> DataFrame:
    """For each row of ``docs(doc_id, text)``: ``row_no``, unique once written, ``doc_id``, ``text_hash`` and ``text_key``, two
    hashes, and by chunk ``digests``, ``sizes`` in words, ``begins`` and ``ends`` in bytes of the text; empty without words."""
    own = ["doc_id", "text_hash", "text_key"]
    docs = docs.select(F.col("doc_id").cast("long"), *_hashes("text"), F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in pieces(offsets):
                row, begin, end, size, digest = chunks(data, offsets[a : b + 1])
                edges = pa.array(np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32))
                start = offsets[a + row]
                values = digest.view(np.int64), size.astype(np.int32), (begin - start).astype(np.int32), (end - start).astype(np.int32)
                lists = [pa.ListArray.from_arrays(edges, pa.array(v)) for v in values]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(number, number + b - a)), *(batch.column(c).slice(a, b - a) for c in own), *lists], names=["row_no", *own, "digests", "sizes", "begins", "ends"])
                number += b - a

    return docs.mapInArrow(run, "row_no long, doc_id long, text_hash long, text_key long, digests array<bigint>, sizes array<int>, begins array<int>, ends array<int>")


def _hashes(text: str) -> list[Column]:
    text = F.col(text).cast("string")
    return [F.xxhash64(text).alias("text_hash"), F.xxhash64(F.lit("key"), text).alias("text_key")]


def _windows(docs: DataFrame, spots: DataFrame, reach: int) -> DataFrame:
    """For each of ``spots(text_hash, text_key, pos, side)``, distinct, the words of the text in ``reach`` bytes before (side 0)
    or after (1) the place, from there on: ``words``, 32 bits of their hashes, ``far``, bytes from the place to the far end
    of each, and ``more``, whether the text goes on beyond these bytes."""
    keys = ["text_hash", "text_key"]
    # a text has a place for either end of each of its chunks at most
    by_text = written(spots.groupBy(*keys).agg(F.collect_list(F.struct("pos", "side")).alias("spots")), "chunk-spots")
    near = (by_text.agg(F.sum(F.size("spots"))).first()[0] or 0) <= FEW
    texts = docs.select(F.col("text").cast("string")).select("text", *_hashes("text")).join(F.broadcast(by_text) if near else by_text, keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            lists = batch.column("spots")
            edges = lists.offsets.to_numpy()
            row = np.repeat(np.arange(len(batch)), np.diff(edges))
            flat = lists.flatten()
            pos, side = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            at = offsets[row] + pos
            a = np.where(side == 0, np.maximum(offsets[row], at - reach), at)
            b = np.where(side == 0, at, np.minimum(offsets[row + 1], at + reach))
            for i, j in pieces(np.concatenate([[0], np.cumsum(b - a)])):
                raw = b"".join(data[x:y].tobytes() for x, y in zip(a[i:j].tolist(), b[i:j].tolist(), strict=True))
                starts = np.concatenate([[0], np.cumsum(b[i:j] - a[i:j])])
                spot, begin, end, h = words(np.frombuffer(raw, np.uint8), starts)
                left = side[i:j][spot] == 0
                # a word that the window cuts is none
                cut_left = left & (begin == starts[spot]) & (a[i:j][spot] > offsets[row[i:j][spot]]) & ~SPACE[data[np.maximum(a[i:j][spot] - 1, 0)]]
                after = np.minimum(b[i:j][spot], len(data) - 1)
                cut_right = ~left & (end == starts[spot + 1]) & (b[i:j][spot] < offsets[row[i:j][spot] + 1]) & ~SPACE[data[after]]
                whole = ~(cut_left | cut_right)
                spot, begin, end, h, left = (x[whole] for x in (spot, begin, end, h, left))
                far = np.where(left, starts[spot + 1] - begin, end - starts[spot])
                order = np.lexsort((far, spot))
                cuts = pa.array(np.searchsorted(spot, np.arange(j - i + 1)).astype(np.int32))
                lists_ = [pa.ListArray.from_arrays(cuts, pa.array(v[order])) for v in ((h >> np.uint64(32)).astype(np.uint32).view(np.int32), far.astype(np.int32))]
                taken = pa.array(row[i:j])
                more = np.where(side[i:j] == 0, a[i:j] > offsets[row[i:j]], b[i:j] < offsets[row[i:j] + 1])
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(taken) for k in keys), pa.array(pos[i:j].astype(np.int32)), pa.array(side[i:j].astype(np.int32)), *lists_, pa.array(more)], names=[*keys, "pos", "side", "words", "far", "more"])

    found = texts.mapInArrow(run, "text_hash long, text_key long, pos int, side int, words array<int>, far array<int>, more boolean")
    return written(found.dropDuplicates([*keys, "pos", "side"]), "chunk-windows")


def _moved(docs: DataFrame, ends: DataFrame, reach: int) -> DataFrame:
    """``ends(row_no, a, own, ref)`` with ``side``, ``more`` words that are alike beyond both places, ``by`` how many bytes of
    the own text, and ``open``, whether they are all that ``reach`` bytes have and there are more."""
    windows = _windows(docs, ends.select("own.*").union(ends.select("ref.*")).distinct(), reach)
    for c in ("own", "ref"):
        side = windows.select(F.struct("text_hash", "text_key", "pos", "side").alias(c), F.col("words").alias(f"{c}_words"), F.col("more").alias(f"{c}_more"), *([F.col("far").alias("far")] if c == "own" else []))
        ends = ends.join(side, c)
    differ = F.zip_with("own_words", "ref_words", lambda x, y: x.isNull() | y.isNull() | (x != y))
    same = F.array_position(differ, F.lit(True)).cast("int")
    same = F.when(same > 0, same - 1).otherwise(F.size(differ))
    open_ = ((same == F.size("own_words")) & F.col("own_more")) | ((same == F.size("ref_words")) & F.col("ref_more"))
    return ends.select("row_no", "a", "own", "ref", F.col("own.side").alias("side"), same.alias("more"), F.coalesce(F.get("far", same - 1), F.lit(0)).alias("by"), open_.alias("open"))


def passages(docs: DataFrame, least_words: int = LEAST_WORDS, reach: int = REACH) -> DataFrame:
    """A row for each repeated passage: ``doc_id``, ``text_hash``, ``begin`` and ``end`` in bytes of the text's UTF-8,
    ``n_words``, and ``first_doc_id``, where its first whole chunk is first.

    Chunks are first in the document with the smallest doc_id (null first), and there at the smallest place; all later ones
    repeat them, also within a document.  A passage is a run of repeating chunks and the words on either side, as far as they
    are also those beside the first occurrence of the run's first or last chunk (``reach`` bytes are read first, and more
    where all of these agree); it has at least ``least_words`` words.  Words are compared without the case of A-Z and whatever the white space between them.  Two
    passages of a text can overlap.  Null and empty texts have no passages.  Rows that repeat a doc_id are told apart, and
    all but one repeat.  Other columns are ignored.
    """
    table = written(chunked(docs), "chunks")
    rows = table.select("row_no", "doc_id", F.posexplode("digests").alias("no", "digest"))
    first = rows.groupBy("digest").agg(F.min(F.struct("doc_id", "row_no", "no")).alias("first"), F.count("*").alias("n"))
    # a table of its own, so that the join with a chunk that very many texts have can be split at run time
    first = written(first.where("n > 1").select("digest", "first"), "first-chunks")
    again = rows.select("row_no", "no", "digest").join(first, "digest")
    again = again.where((F.col("first.row_no") != F.col("row_no")) | (F.col("first.no") != F.col("no"))).select("row_no", "no", "first")
    run = F.col("no") - F.row_number().over(Window.partitionBy("row_no").orderBy("no"))
    runs = again.withColumn("run", run).groupBy("row_no", "run").agg(F.min("no").alias("a"), F.max("no").alias("b"), F.min_by("first", "no").alias("from_"), F.max_by("first", "no").alias("to"))
    own = runs.join(table.drop("digests"), "row_no")
    n_words = F.aggregate(F.slice("sizes", F.col("a") + 1, F.col("b") - F.col("a") + 1), F.lit(0), lambda x, y: x + y)
    beside = sum((F.coalesce(F.get("sizes", F.col(c) + d), F.lit(0)) for c, d in (("a", -2), ("a", -1), ("b", 1), ("b", 2))), F.lit(0))
    own = own.withColumn("n_words", n_words).where(F.col("n_words") + beside >= least_words)
    spot = lambda pos, side: F.struct("text_hash", "text_key", pos.alias("pos"), F.lit(side).alias("side"))
    own = own.select("row_no", "a", "doc_id", "n_words", F.col("from_.doc_id").alias("first_doc_id"), spot(F.get("begins", F.col("a")), 0).alias("left"), spot(F.get("ends", F.col("b")), 1).alias("right"), "from_", "to")
    runs = written(own, "chunk-runs")
    # either end of a run, and the chunk whose first occurrence it is compared with
    ends = runs.select("row_no", "a", F.explode(F.array(F.struct(F.col("left").alias("own"), F.col("from_").alias("there")), F.struct(F.col("right").alias("own"), F.col("to").alias("there")))).alias("x"))
    ends = ends.select("row_no", "a", "x.own", F.col("x.there.row_no").alias("there"), F.col("x.there.no").alias("no"), F.col("x.own.side").alias("side"))
    refs = ends.select(F.col("there").alias("row_no"), "no", "side").distinct().join(table.select("row_no", "text_hash", "text_key", "begins", "ends"), "row_no")
    place = F.when(F.col("side") == 0, F.get("begins", F.col("no"))).otherwise(F.get("ends", F.col("no")))
    refs = refs.select(F.col("row_no").alias("there"), "no", "side", F.struct("text_hash", "text_key", place.alias("pos"), "side").alias("ref"))
    ends = written(ends.join(refs, ["there", "no", "side"]).select("row_no", "a", "own", "ref"), "chunk-ends")
    moved = None
    while True:
        step = written(_moved(docs, ends, reach), "chunk-moves")
        done = step.where("not open").select("row_no", "a", "side", "more", "by")
        moved = done if moved is None else moved.union(done)
        ends, reach = step.where("open").select("row_no", "a", "own", "ref"), reach * FARTHER
        if not ends.take(1):
            break
    by = lambda s: F.sum(F.when(F.col("side") == s, F.col("by")).otherwise(0)).cast("int")
    moved = moved.groupBy("row_no", "a").agg(F.sum("more").cast("int").alias("more"), by(0).alias("back"), by(1).alias("on"))
    found = runs.join(moved, ["row_no", "a"]).withColumn("n_words", F.col("n_words") + F.col("more")).where(F.col("n_words") >= least_words)
    return found.select("doc_id", F.col("left.text_hash").alias("text_hash"), (F.col("left.pos") - F.col("back")).alias("begin"), (F.col("right.pos") + F.col("on")).alias("end"), "n_words", "first_doc_id")


def without_passages(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``, their first occurrences left, and ``n_chars`` set anew if there is
    such a column.  Every row stays.  Of rows that repeat a doc_id with the same text each loses what any of them repeats.
    Names of other columns must not begin with ``_cut``."""
    spans = passages(docs, least_words).groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set(F.struct("begin", "end"))).alias("_cut"))
    spans = spans.select(F.col("doc_id").alias("_cut_id"), F.col("text_hash").alias("_cut_hash"), "_cut")
    hashed = docs.withColumn("_cut_text", F.xxhash64(F.col("text").cast("string")))
    out = hashed.join(spans, F.col("doc_id").cast("long").eqNullSafe(F.col("_cut_id")) & (F.col("_cut_text") == F.col("_cut_hash")), "left").drop("_cut_id", "_cut_text", "_cut_hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, place = [], batch.schema.names.index("text")
            for text, spans in zip(batch.column("text"), batch.column("_cut").to_pylist(), strict=True):
                if not spans:
                    texts.append(text.as_py())
                    continue
                raw, kept, at = memoryview(text.as_buffer()), [], 0
                for x in spans:
                    kept.append(raw[at : max(at, x["begin"])])
                    at = max(at, x["end"])
                texts.append(b"".join([*kept, raw[at:]]).decode())
            columns = batch.columns
            columns[place] = pa.array(texts, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    if not isinstance(docs.schema["text"].dataType, T.StringType):
        out = out.withColumn("text", F.col("text").cast("string"))
    out = out.mapInArrow(run, out.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("_cut").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out.select(docs.columns)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "first_doc_id", "begin", "end", "n_words")


QUERIES = {"op5_substring_dedup": op5_substring_dedup}

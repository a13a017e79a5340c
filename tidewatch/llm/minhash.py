"""Near-duplicate documents by ProbMinHash over weighted word shingles, banding and verification.

Every distinct shingle of five words starts a Poisson process whose rate is its weight; each arrival goes to a random
register, which keeps its earliest one.  Arrivals are drawn round by round, and a shingle stops once its time is past
the latest register of its document.  Two documents agree in a register with the probability Jaccard of their weights.
Registers are grouped into bands; documents that share a band are candidates, and a link is the Jaccard similarity
of two documents' shingle sets, verified on whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import written
from ._text import mix, pieces, utf8, words
from .components import components, forest

#: How much greater than 1 a weight can be.  With weights of 1 to 1 + SPREAD two texts whose sets have the Jaccard similarity J
#: agree in a register with the probability J / (1 + SPREAD) at least, however often either repeats a shingle.
SPREAD = 0.02
#: Words of a shingle, least similarity of a link, bands and registers of a band: a pair at 0.8 is missed once in 1500 at most.
SHINGLE, THRESHOLD, BANDS, ROWS = 5, 0.8, 28, 6
#: Rounds of comparing with one centre for each bucket; rows up to which the rest of a bucket is compared pair by pair; classes
#: of a block, and shingles that blocks are compared by at once, beyond that.
ROUNDS, SMALL, BLOCK, COLUMNS = 2, 24, 256, 4096
#: Rows of a bucket that are joined with what is known of it in one task; a larger bucket is dealt out.
DEALT = 4096


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all rows: row, hash, count; and by row a hash of all its words, 0 if it has none.

    A row of fewer than ``k`` words has all its words as its one shingle.
    """
    row, _, _, h = words(data, offsets)
    n_rows = len(offsets) - 1
    count = np.bincount(row, minlength=n_rows)
    first = np.cumsum(count) - count
    step = np.uint64(0xD6E8FEB86659FD93)

    def joined(starts: np.ndarray, size: int) -> np.ndarray:
        x = np.full(len(starts), size, np.uint64)
        for j in range(size):
            x = mix(x * step + h[starts + j])
        return x

    starts = np.flatnonzero(row[: len(row) - k + 1] == row[k - 1 :]) if len(row) >= k else np.zeros(0, np.int64)
    rows, hashes = [row[starts]], [joined(starts, k)]
    for size in range(1, k):
        short = np.flatnonzero(count == size)
        rows.append(short)
        hashes.append(joined(first[short], size))
    rows, hashes = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.append(True, (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1]))[: len(rows)]
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(rows)))
    place = np.arange(len(row)) - first[row] if len(row) else row
    whole = np.zeros(n_rows, np.uint64)
    np.add.at(whole, row, mix(h + mix(place.astype(np.uint64) + np.uint64(1))))
    whole = np.where(count > 0, mix(whole + count.astype(np.uint64)) | np.uint64(1), np.uint64(0))
    return rows[at], hashes[at], times, whole


def probminhash(row: np.ndarray, element: np.ndarray, weight: np.ndarray, n_rows: int, registers: int) -> np.ndarray:
    """The element of the earliest arrival in each register: [row, register]; rows without elements have zeros."""
    time = np.full(n_rows * registers, np.inf)
    won = np.zeros(n_rows * registers, np.uint64)
    now = np.zeros(len(row))
    latest = np.full(n_rows, np.inf)
    active = np.arange(len(row))
    turn = 0
    while len(active):
        turn += 1
        x = mix(element[active] + np.uint64(turn * 0x9E3779B97F4A7C15 % (1 << 64)))
        now = now - np.log(((x >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53) / weight[active]
        early = now < latest[row[active]]
        active, now, x = active[early], now[early], x[early]
        place = row[active] * registers + (mix(x ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(time, place, now)
        best = time[place] == now
        won[place[best]] = element[active[best]]
        touched = np.unique(row[active])
        latest[touched] = time.reshape(n_rows, registers)[touched].max(1)
        early = now < latest[row[active]]
        active, now = active[early], now[early]
    return won.reshape(n_rows, registers)


def weights(times: np.ndarray) -> np.ndarray:
    """A shingle's weight grows with how often the document has it, to less than 1 + SPREAD: links are of sets."""
    return 1 + SPREAD * (1 - 1 / times)


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash``, ``row_no``, unique once written, ``fp`` (a hash of all words; null if there are none) and
    ``bands`` (null likewise) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in pieces(offsets):
                row, element, times, whole = shingles(data, offsets[a : b + 1])
                won = probminhash(row, element, weights(times), b - a, BANDS * ROWS).reshape(b - a, BANDS, ROWS)
                band = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (b - a, BANDS)).copy()
                for i in range(ROWS):
                    band = mix(band * np.uint64(0xD6E8FEB86659FD93) + won[:, :, i])
                none = pa.array(whole == 0)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * BANDS), pa.array(band.ravel().view(np.int64)), mask=none)
                own = [*(batch.column(c).slice(a, b - a) for c in ("doc_id", "text_hash")), pa.array(np.arange(number, number + b - a))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(whole.view(np.int64), mask=whole == 0), lists], names=["doc_id", "text_hash", "row_no", "fp", "bands"])
                number += b - a

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(run, "doc_id long, text_hash long, row_no long, fp long, bands array<bigint>")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``fp`` and ``set``, 32 bits of the hashes of the distinct shingles, of each document that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in pieces(offsets):
                row, element, _, whole = shingles(data, offsets[a : b + 1])
                edges = np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32)
                sets = pa.ListArray.from_arrays(pa.array(edges), pa.array((element >> np.uint64(32)).astype(np.uint32).view(np.int32)))
                has = pa.array(whole != 0)
                yield pa.RecordBatch.from_arrays([pa.array(whole.view(np.int64)).filter(has), sets.filter(has)], names=["fp", "set"])

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "fp long, set array<int>")


def _compared(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``pairs(a, b)`` with ``linked``, whether their shingle sets are similar enough."""
    one, two = (sets.select(F.col("fp").alias(c), F.col("set").alias(f"set_{c}")) for c in "ab")
    both = pairs.join(one, "a").join(two, "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    whole = F.size(F.array_distinct("set_a")) + F.size(F.array_distinct("set_b")) - common
    return both.select("a", "b", (common >= threshold * whole).alias("linked"))


def _blocks_compared(threshold: float):
    """Links between the two sides of each group of rows, as those of a forest; rows of a group follow each other."""

    def group(side: np.ndarray, fp: np.ndarray, label: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(left) or not len(right):
            return fp[:0], fp[:0]
        size = np.array([len(x) for x in sets])
        value = np.concatenate([sets[i] for i in (*left, *right)])
        row = np.repeat(np.arange(len(side)), size[np.concatenate([left, right])])
        _, column = np.unique(value, return_inverse=True)
        cut = int(size[left].sum())
        both = np.zeros(column.max() + 1, bool)
        both[column[:cut]] = True
        shared = np.zeros_like(both)
        shared[column[cut:]] = True
        shared &= both
        rank = np.cumsum(shared) - 1
        kept = shared[column]
        row, column, on_left = row[kept], rank[column[kept]], (np.arange(len(column)) < cut)[kept]
        row = np.where(on_left, row, row - len(left))
        order = np.argsort(column, kind="stable")
        row, column, on_left = row[order], column[order], on_left[order]
        common = np.zeros((len(left), len(right)), np.float32)
        for at in range(0, int(shared.sum()), COLUMNS):  # sizes of intersections, some shingles at a time
            part = slice(*np.searchsorted(column, [at, at + COLUMNS]))
            x, y = np.zeros((len(left), COLUMNS), np.float32), np.zeros((len(right), COLUMNS), np.float32)
            one = on_left[part]
            x[row[part][one], column[part][one] - at] = 1
            y[row[part][~one], column[part][~one] - at] = 1
            common += x @ y.T
        close = common >= threshold * (size[left][:, None] + size[right] - common)
        p, q = np.nonzero(close & (label[left][:, None] != label[right]))
        moved, least = forest(left[p], right[q], len(side))
        return fp[moved], fp[least[moved]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            side, fp, label, sets = zip(*held, strict=True)
            a, b = group(np.array(side), np.array(fp), np.array(label), list(sets))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("block", "i", "j", "side", "fp", "at")), strict=True)
            for (block, i, j, side, fp, label), own in zip(keys, batch.column("set"), strict=True):
                if (block, i, j) != at:
                    if held:
                        yield from done()
                    at, held = (block, i, j), []
                held.append((side, fp, label, np.unique(own.values.to_numpy())))
        if held:
            yield from done()

    return run


def _dealt(buckets: DataFrame) -> DataFrame:
    """What is known of each bucket, once for each of the parts that its rows are dealt out to."""
    return buckets.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")


def _large_compared(state: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links among the classes of large buckets, whatever their labels: those outside the most frequent label of what
    the buckets hold together, block by block, with all."""
    least = _dealt(state.groupBy("bucket").agg(F.min("fp").alias("b"), F.max("parts").alias("parts")))
    whole = components(state.join(least, ["bucket", "part"]).select(F.col("fp").alias("a"), "b"))
    rows = state.select("fp", "at").distinct().join(whole.select(F.col("node").alias("fp"), F.col("component").alias("block")), "fp")
    per = rows.groupBy("block", "at").agg(F.count("*").alias("m"))
    main = per.groupBy("block").agg(F.sum("m").alias("n"), F.max(F.struct("m", "at")).alias("top"))
    main = main.select("block", F.col("top.at").alias("main"), F.ceil(F.col("n") / BLOCK).cast("int").alias("all"), F.ceil((F.col("n") - F.col("top.m")) / BLOCK).cast("int").alias("some"))
    rows = written(rows.join(main, "block").where("some > 0").join(sets, "fp"), "block-rows")
    spot = lambda c: F.pmod(F.xxhash64("fp"), F.col(c)).cast("int")
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    names = ["block", "i", "j", "side", "fp", "at", "set"]
    left = rows.where("at <> main").withColumns({"i": spot("some"), "side": F.lit(0)}).withColumn("j", upto("all"))
    right = rows.withColumns({"j": spot("all"), "side": F.lit(1)}).withColumn("i", upto("some"))
    dealt = left.select(names).unionByName(right.select(names)).repartition("block", "i", "j").sortWithinPartitions("block", "i", "j")
    return dealt.mapInArrow(_blocks_compared(threshold), "a long, b long")


def links(docs: DataFrame, classes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links between classes, ``a`` and ``b``, that have the components of all links between candidates.

    Classes that share a band are candidates.  A bucket is not spread into all its pairs: in each of ``ROUNDS`` rounds
    every class is compared with one centre of each of its buckets and takes the label of those it links with.  Then
    classes with another label than most of their bucket are compared with all of it: pair by pair if the bucket is
    small, or else in blocks that give only links.  So a candidate pair stays uncompared only where links join it already.
    """
    rows = classes.select(F.explode("bands").alias("bucket"), "fp")
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket", F.ceil(F.col("n") / DEALT).cast("int").alias("parts"))
    members = written(rows.join(shared, "bucket").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")), "band-members")
    wanted = members.select("fp").distinct().join(classes, "fp").select("doc_id")
    sets = shingle_sets(docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi"))
    sets = written(sets.join(members.select("fp").distinct(), "fp", "left_semi").dropDuplicates(["fp"]), "shingle-sets")
    compared, labels = None, None
    for turn in range(ROUNDS + 1):
        state = members.withColumn("at", F.col("fp")) if labels is None else members.join(labels, "fp")
        per = state.groupBy("bucket", "at").agg(F.count("*").alias("m"), F.max("parts").alias("parts"))
        open_ = per.groupBy("bucket").agg(F.sum("m").alias("m"), F.count("*").alias("labels"), F.max(F.struct("m", "at")).alias("top"), F.max("parts").alias("parts")).where("labels > 1")
        open_ = _dealt(open_.select("bucket", "m", F.col("top.at").alias("main"), "parts"))
        live = written(state.join(open_, ["bucket", "part"]), "band-live")
        if turn == ROUNDS:
            break
        pick = F.min(F.struct(F.xxhash64(F.lit(turn), "fp").alias("h"), "fp", "at")).alias("c")
        centre = _dealt(live.groupBy("bucket").agg(pick, F.max("parts").alias("parts")).select("bucket", F.col("c.fp").alias("b"), F.col("c.at").alias("at_b"), "parts"))
        pairs = live.select("bucket", "part", F.col("fp").alias("a"), F.col("at").alias("at_a")).join(centre, ["bucket", "part"]).where("at_a <> at_b")
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = pairs if compared is None else pairs.join(compared.select("a", "b"), ["a", "b"], "left_anti")
        new = written(_compared(pairs, sets, threshold), "pairs")
        compared = new if compared is None else compared.union(new)
        own = state.select("fp", "at").distinct()
        ends = new.where("linked").select("a", "b")
        offers = ends.union(ends.select("b", "a")).join(own.select(F.col("fp").alias("b"), "at"), "b").select(F.col("a").alias("fp"), "at")
        labels = written(own.union(offers).groupBy("fp").agg(F.min("at").alias("at")), "labels")
    few, many = live.where(F.col("m") <= SMALL), live.where(F.col("m") > SMALL)
    left = few.where(F.col("at") != F.col("main")).select("bucket", F.col("fp").alias("a"), F.col("at").alias("at_a"))
    pairs = left.join(few.select("bucket", F.col("fp").alias("b"), F.col("at").alias("at_b")), "bucket").where("at_a <> at_b")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(compared.select("a", "b"), ["a", "b"], "left_anti")
    found = compared.union(_compared(pairs, sets, threshold)).where("linked").select("a", "b")
    return found.union(_large_compared(many.select("bucket", "part", "parts", "fp", "at"), sets, threshold))


#: A null doc_id counts as this one.
NO_ID = -(1 << 63)
#: A byte that is no ASCII white space, so of a word.
WORD = r"[^ \t\n\x0b\f\r]"


def _classified(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """``doc_id``, ``text_hash``, ``row_no`` and ``fp`` of each row; and by ``fp`` the class ``at`` that links reach and the
    smallest ``(doc_id, text_hash, row_no)`` that has these words."""
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), "text")
    sketched = written(sketches(docs), "sketches")
    least = F.min(F.struct("doc_id", "text_hash", "row_no")).alias("least")
    classes = sketched.where("fp is not null").groupBy("fp").agg(least, F.first("bands").alias("bands"))
    classes = written(classes.select("fp", "least.doc_id", "least.text_hash", "least.row_no", "bands"), "text-classes")
    groups = components(links(docs, classes, threshold))
    ids = classes.join(groups, F.col("fp") == F.col("node"), "left").select("fp", "doc_id", "text_hash", "row_no", F.coalesce("component", "fp").alias("at"))
    return sketched.select("doc_id", "text_hash", "row_no", "fp"), ids


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``class_id``, ``class_hash`` and ``kept`` for each row of ``docs(doc_id, text)``: the class is the smallest
    doc_id that links reach, and one row of each class is kept, one with this doc_id.

    Words are runs of other bytes than ASCII white space, A-Z in lower case; documents of the same words are alike.
    A null text, or one without words, is like no other and its own class, which has no hash.  A null doc_id counts as the
    smallest long.  Rows that repeat a doc_id each have the class of their text; classes that share their smallest doc_id
    are told apart by ``class_hash``, which no two classes share.  Whole texts are read; other columns are ignored.
    """
    rows, ids = _classified(docs, threshold)
    least = ids.groupBy("at").agg(F.min(F.struct("doc_id", "text_hash", "row_no")).alias("least"))
    by_text = ids.select("fp", "at").join(least, "at").select("fp", F.col("at").alias("class_hash"), F.col("least.doc_id").alias("class_id"), F.col("least.row_no").alias("keeps"))
    out = rows.select("doc_id", "row_no", "fp").join(by_text, "fp", "left")
    none = F.lit(NO_ID)
    kept = F.col("fp").isNull() | (F.col("row_no") == F.col("keeps"))
    return out.select(F.nullif(F.col("doc_id"), none).alias("doc_id"), F.nullif(F.coalesce("class_id", "doc_id"), none).alias("class_id"), "class_hash", kept.alias("kept"))


def deduplicated(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class, that with the smallest doc_id (null first) and then hash of its text.

    Classes are of texts, whatever the ids: rows of other classes that repeat a doc_id, or have none, stay, as does every
    row without words.
    """
    _, ids = _classified(docs, threshold)
    chosen = ids.groupBy("at").agg(F.min(F.struct("doc_id", "text_hash")).alias("least")).select(F.col("least.doc_id").alias("_key"), F.col("least.text_hash").alias("_hash"))
    text = F.col("text").cast("string")
    rows = docs.withColumns({"_key": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "_hash": F.xxhash64(text)})
    has_words = F.coalesce(text.rlike(WORD), F.lit(False))
    kept = rows.where(has_words).dropDuplicates(["_key", "_hash"]).join(chosen, ["_key", "_hash"], "left_semi")
    return kept.select(docs.columns).union(docs.where(~has_words))


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op1_minhash_dedup": op1_minhash_dedup}

"""Near duplicates among embeddings: cross-polytope hashing after fast Hadamard rotations, multiprobe buckets, verified pairs.

Equal vectors are one class.  A class has a bucket in each table, that of the largest coordinate (with its sign) after a
pseudo-random rotation, and probes the buckets of the next largest ones.  Candidates of a bucket are compared in the task
that holds them; a bucket that is too large for that is cut into blocks and every two blocks meet in a task of their own.

What goes to a bucket is a copy of the vector in 16 bits a component with a bound on its error.  The copies tell nearly all
pairs apart from the threshold; the few within the bound of it are compared again, in double precision, from the vectors
themselves.  A pair is counted where its first table has it, so of all others nothing is emitted but sums by vector and
links of a spanning forest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._store import written
from ._text import mix, utf8
from .components import components, forest

#: Candidates of a bucket that one task compares; a larger bucket is cut into blocks of half as many.
BLOCK = 1024
#: Cut buckets up to which their table is broadcast.
FEW = 1_000_000
#: Labels up to which their numbers are broadcast.
FEW_LABELS = 100_000
#: Rows that a bucket is planned to have, probes besides the own bucket, and the share of links to be found.
OCCUPANCY, PROBES, RECALL = 64, 2, 0.999


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, width = x.shape
    h = 1
    while h < width:
        y = x.reshape(n, width // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(n, width)
        h *= 2
    return x / math.sqrt(width)


def signatures(x: np.ndarray, tables: int, hashes: int, probes: int, seed: int = 7) -> np.ndarray:
    """Bucket numbers of unit vectors: [row, table, 0] is the own bucket, the rest are probed ones, nearest first."""
    n, dim = x.shape
    width = 1 << max(1, (dim - 1).bit_length())
    signs = np.random.default_rng([seed, width]).choice([-1.0, 1.0], (tables, hashes, 3, width))
    padded = np.zeros((n, width))
    padded[:, :dim] = x
    out = np.empty((n, tables, 1 + probes), np.uint64)
    near = min(width, 1 + probes)
    rows = np.arange(n)
    for t in range(tables):
        code, loss = np.empty((n, hashes, near), np.int64), np.empty((n, hashes, near))
        for k in range(hashes):
            y = padded
            for s in signs[t, k]:
                y = hadamard(y * s)
            size = np.abs(y)
            top = np.argsort(-size, 1, kind="stable")[:, :near]
            code[:, k] = 2 * top + (y[rows[:, None], top] < 0)
            loss[:, k] = size[rows[:, None], top[:, :1]] - size[rows[:, None], top]
        place = np.array([(2 * width + 1) ** k for k in range(hashes)], dtype=np.uint64)
        own = (code[:, :, 0].astype(np.uint64) * place).sum(1, dtype=np.uint64)
        out[:, t, 0] = own
        # a probe takes one hash's next best coordinate; those that lose least come first
        order = np.argsort(loss[:, :, 1:].reshape(n, -1), 1, kind="stable")[:, :probes]
        k, j = order // (near - 1), order % (near - 1) + 1
        for p in range(probes):
            kp, jp = k[:, min(p, k.shape[1] - 1)], j[:, min(p, k.shape[1] - 1)]
            out[:, t, 1 + p] = own + (code[rows, kp, jp] - code[rows, kp, 0]).astype(np.uint64) * place[kp]
        out[:, t] = mix(mix(out[:, t]) + np.uint64(t))
    return out


def meets(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of two arrays of signatures share a bucket that is at least one's own: [row, table]."""
    return (a[:, :, :1] == b).any(2) | (b[:, :, :1] == a).any(2)


def plan(rows: int, dim: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """Tables and hashes of a table: so many hashes that buckets have about ``OCCUPANCY`` of ``rows``, and so many tables
    that a pair just at the threshold is missed with a chance under 1 - recall, by trial on made-up pairs."""
    width = 1 << max(1, (dim - 1).bit_length())
    hashes = max(1, math.ceil(math.log(max(1, rows / OCCUPANCY)) / math.log(2 * width)))
    r = np.random.default_rng(1)
    x, y = r.normal(size=(2, 2000, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y -= (x * y).sum(1)[:, None] * x
    y /= np.maximum(np.linalg.norm(y, axis=1), 1e-9)[:, None]
    y = threshold * x + math.sqrt(max(0, 1 - threshold**2)) * y
    hit = meets(signatures(x, 4, hashes, PROBES), signatures(y, 4, hashes, PROBES)).mean()
    return max(2, math.ceil(math.log(1 - recall) / math.log(max(1e-6, 1 - hit)))), hashes


def _copy(dim: int) -> np.dtype:
    """What goes to a bucket: number and size of a class, label, vector in 16 bits, their unit, and how far off it is."""
    return np.dtype([("no", "<i8"), ("size", "<i8"), ("label", "<i8"), ("unit", "<f4"), ("slack", "<f4"), ("q", "<i2", (dim,))])


def _directions(copies: np.ndarray) -> np.ndarray:
    x = copies["q"] * copies["unit"].astype(np.float64)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def _signed(copies: np.ndarray, x: np.ndarray, tables: int, hashes: int) -> np.ndarray:
    """Buckets of copies: alike wherever they are computed."""
    place = mix(copies["label"].astype(np.uint64) * np.uint64(1 << 20) + np.uint64(x.shape[1]))
    return mix(signatures(x, tables, hashes, PROBES) + place[:, None, None])


def _compare(threshold: float, tables: int, hashes: dict[int, int]):
    """Compares the candidates of each group of rows; rows of a group follow each other, over batches."""
    wide = 1 + PROBES

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        key, parts = None, []
        for batch in batches:
            bucket, i, j, at, block = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "i", "j", "at", "block"))
            raw, edges = utf8(batch.column("copy"))
            size = np.diff(edges)
            new = (bucket[1:] != bucket[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]) | (size[1:] != size[:-1])
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(batch)] if len(batch) else [0]
            for a, b in zip(cuts, cuts[1:], strict=False):
                here = (bucket[a], i[a], j[a], size[a])
                if here != key:
                    if parts:
                        yield key, parts
                    key, parts = here, []
                parts.append((at[a:b], block[a:b], raw[edges[a] : edges[b]].tobytes()))
        if parts:
            yield key, parts

    def compared(key: tuple, parts: list) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
        at, block = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        own = at % wide == 0
        if len(at) < 2 or not own.any():
            return
        copies = np.frombuffer(b"".join(p[2] for p in parts), _copy((int(key[3]) - 32) // 2))
        # vectors of few components can probe a bucket twice: each stays once, as its own bucket's if it is that
        order = np.lexsort((~own, copies["no"]))
        order = order[np.append(True, copies["no"][order[1:]] != copies["no"][order[:-1]])]
        t, bucket, split = int(at[0]) // wide, np.int64(key[0]).view(np.uint64), key[1] != key[2]
        copies, own, block = copies[order], own[order], block[order]
        x = _directions(copies)
        slack = 2.001 * copies["slack"].astype(np.float64) + 1e-9
        far = x @ x.T - threshold
        margin = slack[:, None] + slack
        close = np.triu(far > -margin, 1) & (own[:, None] | own) & (copies["label"][:, None] == copies["label"])
        if split:
            close &= block[:, None] != block  # pairs within a block meet in that block's own task
        p, q = np.nonzero(close)
        if not len(p):
            return
        some, back = np.unique(np.concatenate([p, q]), return_inverse=True)
        sig = _signed(copies[some], x[some], tables, hashes[x.shape[1]])
        sp, sq = sig[back[: len(p)]], sig[back[len(p) :]]
        first = ~meets(sp[:, :t], sq[:, :t]).any(1)
        # two buckets of one table may have the pair: the smaller counts
        none = np.uint64(0xFFFFFFFFFFFFFFFF)
        best = np.minimum(np.where((sp[:, t, :1] == sq[:, t]).any(1), sp[:, t, 0], none), np.where((sq[:, t, :1] == sp[:, t]).any(1), sq[:, t, 0], none))
        keep = first & (best == bucket)
        p, q = p[keep], q[keep]
        sure = far[p, q] >= margin[p, q]
        no, size = copies["no"], copies["size"]
        yield no[p[~sure]], np.zeros((~sure).sum(), np.int64), no[q[~sure]], True
        p, q = p[sure], q[sure]
        if not len(p):
            return
        links = np.zeros(len(no), np.int64)
        np.add.at(links, p, size[q])
        np.add.at(links, q, size[p])
        moved, least = forest(p, q, len(no))
        some = np.flatnonzero(links)
        yield no[some], links[some], no[some], False
        yield no[moved], np.zeros(len(moved), np.int64), no[least[moved]], False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, parts in groups(batches):
            for a, links, b, open_ in compared(key, parts):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(links, pa.int64()), pa.array(b, pa.int64()), pa.array(np.full(len(a), open_))], names=["a", "links", "b", "open"])

    return run


def _cosine(x: str, y: str):
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    return dot(x, y) / F.sqrt(dot(x, x)) / F.sqrt(dot(y, y))


def near_duplicates(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """A row for each row of ``vectors(vec_id, embedding, label)``: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Two vectors link if their labels, of any type that can be grouped, are equal and not null, they have as many components
    and their cosine in double precision is at least ``threshold``.  A vector that is null, empty, zero, or holds a null or
    non-finite component links with nothing and is its own component, as is a row without vec_id.  Repeated rows link
    with each other.  Other columns are ignored.  Every reported link is verified; of the links, those just at the
    threshold are missed with a chance under 1 - ``RECALL``.  Equal vectors are told by 128 bits of hash once grouped.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    single = isinstance(vectors.schema["embedding"].dataType, T.ArrayType) and isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    vectors = vectors.select("vec_id", F.col("embedding").cast("array<float>" if single else "array<double>").alias("embedding"), "label")
    sound = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    keys = {f"k{i}": F.xxhash64(F.lit(i), "label", "embedding") for i in (1, 2)}
    good = vectors.where(sound)
    classes = good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"))
    # labels are numbered, so that copies tell them apart exactly
    labels = written(good.select(F.col("label").alias("of")).distinct().withColumn("label_no", F.monotonically_increasing_id()), "vector-labels")
    named = F.broadcast(labels) if labels.count() <= FEW_LABELS else labels
    classes = written(classes.withColumns(keys).join(named, F.col("label") == F.col("of")).drop("of"), "vector-classes")
    alone = vectors.where(~sound).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    groups = classes.groupBy("label", F.size("embedding").alias("dim")).count().groupBy("dim").agg(F.max("count").alias("n")).collect()  # a row for each width
    if not groups:
        return alone.withColumn("kept", F.lit(True))
    # as many tables as the width that needs most, so that all have the recall
    plans = [plan(r["n"], r["dim"], threshold) for r in groups]
    tables, hashes = max(p[0] for p in plans), {r["dim"]: p[1] for r, p in zip(groups, plans, strict=True)}
    wide = 1 + PROBES

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            sizes = np.diff(batch.column("embedding").offsets.to_numpy())
            sig, copies = np.zeros((len(batch), tables * wide), np.uint64), [b""] * len(batch)
            no = number + np.arange(len(batch))
            label, size = (batch.column(c).to_numpy() for c in ("label_no", "size"))
            for dim in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dim)
                x = batch.column("embedding").take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), dim).astype(np.float64)
                x /= np.abs(x).max(1)[:, None]
                x /= np.linalg.norm(x, axis=1)[:, None]
                own = np.zeros(len(rows), _copy(dim))
                own["no"], own["size"], own["label"] = no[rows], size[rows], label[rows]
                own["unit"] = np.abs(x).max(1) / 32766
                own["q"] = np.rint(x / own["unit"].astype(np.float64)[:, None])
                gap = np.linalg.norm(x - own["q"] * own["unit"].astype(np.float64)[:, None], axis=1)
                own["slack"] = np.nextafter(gap.astype(np.float32), np.float32(1))
                sig[rows] = _signed(own, _directions(own), tables, hashes[dim]).reshape(len(rows), -1)
                for i, r in enumerate(rows.tolist()):
                    copies[r] = own[i].tobytes()
            number += len(batch)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1, dtype=np.int32) * tables * wide), pa.array(sig.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(no), *(batch.column(c) for c in ("k1", "k2", "rep", "size")), pa.array(copies, pa.binary()), lists], names=["no", "k1", "k2", "rep", "size", "copy", "sig"])

    rep = classes.schema["rep"].dataType.simpleString()
    signed = written(classes.mapInArrow(sign, f"no long, k1 long, k2 long, rep {rep}, size long, copy binary, sig array<bigint>"), "vector-signatures")
    large = signed.select(F.explode("sig").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    large = written(large.select("bucket", F.ceil(F.col("n") / (BLOCK // 2)).cast("int").alias("blocks")), "large-buckets")
    rows = signed.select("no", "copy", F.posexplode("sig").alias("at", "bucket"))
    rows = rows.join(F.broadcast(large) if large.count() <= FEW else large, "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("no"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "at", "block", "copy")
    rows = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", F.length("copy"))
    found = written(rows.mapInArrow(_compare(threshold, tables, hashes), "a long, links long, b long, open boolean"), "vector-links")
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda v: v / F.array_max(F.transform("embedding", lambda w: F.abs(w).cast("double"))))
    vector = signed.select("no", "k1", "k2", "size").join(classes.select("k1", "k2", scaled.alias("x")), ["k1", "k2"])
    one, two = (vector.select(F.col("no").alias(c), F.col("size").alias(f"size_{c}"), F.col("x").alias(f"x_{c}")) for c in "ab")
    near = found.where("open").select("a", "b").join(one, "a").join(two, "b")
    near = written(near.where(_cosine("x_a", "x_b") >= threshold).select("a", "b", "size_a", "size_b"), "vector-near")
    links = found.where("links > 0").select("a", "links").union(near.select("a", "size_b")).union(near.select("b", "size_a"))
    links = links.groupBy(F.col("a").alias("no")).agg(F.sum("links").alias("links"))
    linked = components(found.where("not open and a <> b").select("a", "b").union(near.select("a", "b")))
    nodes = signed.select("no", "k1", "k2", "rep", "size").join(linked, F.col("no") == F.col("node"), "left").withColumn("component", F.coalesce("component", "no"))
    least = nodes.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_class = nodes.join(links, "no", "left").join(least, "component").select("k1", "k2", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = good.select("vec_id", *(c.alias(k) for k, c in keys.items())).join(by_class, ["k1", "k2"]).select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 0.93)


QUERIES = {"op9_embedding_dedup": op9_embedding_dedup}

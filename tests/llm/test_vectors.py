"""Clusters and vector codes against a plain version in whole numbers of Python and numpy."""

import collections
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import centroids, codebooks
from tidewatch.llm._vectors import most

SCHEMA = "vec_id long, embedding array<double>, label string"


def whole(rows, scale, width):
    kept = [(i, v, label) for i, v, label in rows if v and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    return [(i, [math.floor(scale * x) for x in v], label) for i, v, label in kept]


def mean(rows):
    return [sum(x) // len(rows) for x in zip(*rows, strict=True)]


def nearest(v, c):
    return min((sum((x - y) ** 2 for x, y in zip(v, e, strict=True)), i) for i, e in enumerate(c))


def brute_clusters(rows, k=40, rounds=5, width=64):
    kept = whole(rows, 256, width)
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    c = [r[1] for r in order[:k]]
    for _ in range(rounds):
        by = collections.defaultdict(list)
        for _, v, _ in kept:
            by[nearest(v, c)[1]].append(v)
        c = [mean(by[i]) if by[i] else e for i, e in enumerate(c)]
    return sorted(((i, *reversed(nearest(v, c))) for i, v, _ in kept), key=repr), c


def brute_codes(rows, parts=4, entries=256, rounds=4, width=64):
    kept = sorted(whole(rows, 1024, width), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = width // parts
    cut = lambda v: [v[p * w : (p + 1) * w] for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in kept[:entries]] for p in range(parts)]
    for _ in range(rounds):
        by = collections.defaultdict(list)
        for _, v, _ in kept:
            for p, x in enumerate(cut(v)):
                by[p, nearest(x, books[p])[1]].append(x)
        books = [[mean(by[p, i]) if by[p, i] else e for i, e in enumerate(book)] for p, book in enumerate(books)]
    found = [(i, label, [nearest(x, books[p]) for p, x in enumerate(cut(v))]) for i, v, label in kept]
    return sorted(((i, label, "".join(f"{n:02x}" for _, n in x), sum(d for d, _ in x)) for i, label, x in found), key=repr), books


def odd(r, n=60, width=64):
    rows = [(i, r.normal(size=width).tolist(), "ab"[i % 2]) for i in range(n)]
    rows += [(100, None, "a"), (101, [], "a"), (102, [1.0] * (width // 2), "a"), (103, [None] + [0.0] * (width - 1), "b"), (104, [math.nan] * width, "b"), (105, [math.inf] * width, None)]
    rows += [(3, rows[3][1], "a"), (3, rows[3][1], "a"), (None, rows[4][1], None), (None, r.normal(size=width).tolist(), None), (106, [0.0] * width, None), (107, [-0.0] * width, "c")]
    return rows


@pytest.mark.parametrize("n", [0, 1, 30, 300])
def test_clusters_by_brute_force(spark, n):
    rows = odd(np.random.default_rng(n), n) if n else [(1, None, "a"), (2, [1.0], "b")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(0) for c in ("q", "near", "low", "rest", "used", "cluster")}).repartition(3)
    got, c = centroids.clustered(df)
    want, want_c = brute_clusters(rows)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert c.tolist() == want_c


@pytest.mark.parametrize("levels", [2, 3, 50])
def test_many_ties_and_hot_vectors(spark, levels):
    """Components of few values: equal distances everywhere, a third of all rows one vector."""
    r = np.random.default_rng(levels)
    rows = [(i, ((r.integers(0, levels, 64) - 1) / 256).tolist() if i % 3 else [0.5] * 64, "x") for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got, c = centroids.clustered(df)
    want, want_c = brute_clusters(rows)
    assert c.tolist() == want_c
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_bounds_spare_measuring_and_bound():
    """Bounds hold after each move, and on clustered vectors most rows measure few centroids or none."""
    r = np.random.default_rng(5)
    middle = r.integers(-900, 900, (12, 64))
    x = middle[r.integers(0, 12, 3000)] + r.integers(-40, 40, (3000, 64))
    c = x[:12].copy()
    near, low, rest = centroids.scanned(x, c, 4)
    spared = []
    for _ in range(6):
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        assert (near[:, 0] == d.argmin(1)).all()
        true = np.sqrt(d)
        assert (low[:, 0] >= np.take_along_axis(true, near[:, :1], 1)[:, 0]).all()
        assert (low[:, 1:] <= np.take_along_axis(true, near[:, 1:], 1)).all()
        others = true.copy()
        np.put_along_axis(others, near, np.inf, 1)
        assert (rest <= others.min(1)).all()
        new = np.stack([x[near[:, 0] == i].mean(0) // 1 if (near[:, 0] == i).any() else c[i] for i in range(12)]).astype(np.int64)
        moves = np.sqrt(((new - c) ** 2).sum(1)) * (1 + centroids.OFF)
        c = new
        near, low, rest, used = centroids.reassigned(x, c, moves, near, low, rest)
        spared.append((used == 0).mean())
    assert spared[-1] > 0.9


@pytest.mark.parametrize("n", [0, 5, 300])
def test_codes_by_brute_force(spark, n):
    rows = odd(np.random.default_rng(n + 1), n) if n else [(1, None, "a"), (2, [math.nan], "b")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(0) for c in ("q", "code", "error", "part")}).repartition(3)
    got, books = codebooks.compressed(df)
    want, want_books = brute_codes(rows)
    assert sorted(map(tuple, got.select("vec_id", "label", "code", "error").collect()), key=repr) == want
    if n:
        assert books.tolist() == want_books
        back = codebooks.decode(got, books)
        for r in back.collect():
            assert r.q == [x for p, i in enumerate(bytes.fromhex(r.code)) for x in want_books[p][i]]


def test_codes_of_other_widths(spark):
    rows = [(i, [float(i), 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, -float(i)], "a") for i in range(20)] + [(50, [1.0] * 4, "a"), (51, [1.0] * 7, "a")]
    got, books = codebooks.compressed(spark.createDataFrame(rows, SCHEMA), entries=8)
    assert books.shape == (4, 8, 2)
    assert sorted(r.vec_id for r in got.collect()) == list(range(20))


def test_components_too_large_raise(spark):
    df = spark.createDataFrame([(1, [2.0**40] * 64, "a"), (2, [0.0] * 64, "a")], SCHEMA)
    with pytest.raises(Exception, match="too large"):
        centroids.clustered(df)
    assert 64 * (2 * most(64)) ** 2 < 2**63


def test_vector_queries_by_brute_force(spark, sf_dir):
    import __spark_entry__

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    queries = __spark_entry__.queries()
    want, c = brute_clusters(rows)
    of = collections.Counter()
    for _, cluster, d in want:
        of[cluster] += d
    sha = lambda x: hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()
    got = sorted(map(tuple, queries["op12_centroid_clustering"](spark, sf_dir).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)
    assert got == [(i, k, d, of[k], sum(of.values()), sha(c[k])) for i, k, d in want]
    want, books = brute_codes(rows)
    of = collections.Counter()
    for _, label, _, e in want:
        of[label] += e
    books = sha([x for book in books for entry in book for x in entry])
    got = sorted(map(tuple, queries["op13_vector_codes"](spark, sf_dir).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)
    assert got == [(i, code, e, of[label], books) for i, label, code, e in want]

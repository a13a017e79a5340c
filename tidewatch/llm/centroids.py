"""Centroid clustering with adaptive bounds on distances.

Every vector has its nearest centroid with an upper bound on the distance, the next nearest ones with a lower bound each, and
one lower bound on all others.  When centroids move, the bounds move with them.  A vector whose upper bound is below all
lower ones keeps its centroid; else only the centroids that come before the first bound above it are measured again, and
all of them only if no bound is.  How many bounds are kept follows what a round has used.

Vectors and centroids are integers, and distances are exact; bounds are rounded away from what they bound, so no
assignment depends on rounding.  The state of a round is a table, and the one before it is deleted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import discard, written
from ._vectors import ROWS, distances, matrix, moved, quantised

#: How far bounds are rounded, and the bound where no centroid is left.
OFF, NONE = 1e-15, 1e300


def measured(x: np.ndarray, c: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of each row of ``near`` sorted by exact squared distance, then number, and those distances."""
    d = ((x[:, None, :] - c[near]) ** 2).sum(2)
    order = np.lexsort((near, d), axis=1)
    return np.take_along_axis(near, order, 1), np.take_along_axis(d, order, 1)


def bounds(d: np.ndarray) -> np.ndarray:
    """From squared distances: an upper bound on the first of each row, lower ones on the others."""
    out = np.sqrt(d.astype(np.float64)) * (1 - OFF)
    out[:, 0] *= (1 + OFF) / (1 - OFF)
    return out


def scanned(x: np.ndarray, c: np.ndarray, kept: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By all centroids: the ``1 + kept`` nearest of each row, their bounds, and the bound on the rest."""
    d = distances(x, c)
    order = np.argsort(d, 1, kind="stable")  # equal ones by number
    low = bounds(np.take_along_axis(d, order[:, : kept + 2], 1))
    rest = low[:, kept + 1] if low.shape[1] > kept + 1 else np.full(len(x), NONE)
    return order[:, : kept + 1], low[:, : kept + 1], rest


def certified(upper: np.ndarray, low: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """How many of the next nearest centroids aren't certain to be farther than the nearest; one more than are kept if the
    rest isn't, either."""
    after = np.concatenate([low[:, 1:], rest[:, None]], 1)
    least = np.minimum.accumulate(after[:, ::-1], 1)[:, ::-1]
    far = np.concatenate([upper[:, None] < least, np.ones((len(upper), 1), bool)], 1)
    return far.argmax(1)


def reassigned(x: np.ndarray, c: np.ndarray, moves: np.ndarray, near: np.ndarray, low: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, ...]:
    """Nearest centroids and bounds after the centroids have moved by at most ``moves``, and the bounds that were used."""
    by = moves[near]
    sign = np.where(np.arange(near.shape[1]) == 0, 1.0, -1.0)
    low = low + sign * by + sign * OFF * (np.abs(low) + by)
    most = moves.max()
    rest = rest - most - OFF * (np.abs(rest) + most)
    used = certified(low[:, 0], low, rest)
    some = np.flatnonzero(used)
    # the distance to the own centroid, exactly, may be all that is needed
    low[some, 0] = bounds(((x[some] - c[near[some, 0]]) ** 2).sum(1)[:, None])[:, 0]
    used[some] = certified(low[some, 0], low[some], rest[some])
    near, kept = near.copy(), near.shape[1] - 1
    for n in np.unique(used[used > 0]).tolist():
        rows = np.flatnonzero(used == n)
        if n <= kept:
            near[rows, : n + 1], d = measured(x[rows], c, near[rows, : n + 1])
            low[rows, : n + 1] = bounds(d)
        else:
            near[rows], low[rows], rest[rows] = scanned(x[rows], c, kept)
    return near, low, rest, used


def _assign(centres, moves: np.ndarray | None, kept: int, final: bool, columns: list[str], width: int):
    """A pass over the vectors: the first one scans, later ones begin with the state that rows have.  The final pass gives
    ``cluster`` and ``distance``, the others the state with ``kept`` bounds."""

    def lists(x: np.ndarray, kind) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel().astype(kind)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = centres.value
        for whole in batches:
            for a in range(0, len(whole), ROWS):
                batch = whole.slice(a, ROWS)
                x = matrix(batch.column("q"), width)
                if moves is None:
                    near, low, rest = scanned(x, c, kept)
                    used = np.full(len(x), 0)
                else:
                    near, low = (np.stack(batch.column(n).to_numpy(zero_copy_only=False)) for n in ("near", "low"))
                    near, low, rest, used = reassigned(x, c, moves, near.astype(np.int64), low, batch.column("rest").to_numpy().copy())
                own = [batch.column(n) for n in columns]
                if final:
                    d = ((x - c[near[:, 0]]) ** 2).sum(1)
                    yield pa.RecordBatch.from_arrays([*own, pa.array(near[:, 0].astype(np.int32)), pa.array(d)], names=[*columns, "cluster", "distance"])
                    continue
                if low.shape[1] > kept + 1:
                    rest = np.minimum(rest, low[:, kept + 1 :].min(1))
                near, low = near[:, : kept + 1], low[:, : kept + 1]
                out = [*own, batch.column("q"), lists(near, np.int32), lists(low, np.float64), pa.array(rest), pa.array(used.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(out, names=[*columns, "q", "near", "low", "rest", "used"])

    return run


def clustered(vectors: DataFrame, *, k: int = 40, rounds: int = 5, scale: int = 256, width: int = 64, seed: str = "2") -> tuple[DataFrame, np.ndarray]:
    """``vec_id``, ``cluster`` and ``distance``, squared, of each vector of ``vectors(vec_id, embedding)`` that is kept, and the
    centroids as integers of ``scale`` times the components.

    Kept are the vectors of exactly ``width`` components, none of them null or not finite.  The first centroids are the ``k``
    kept vectors with the smallest SHA-256 of "seed:vec_id" (those without vec_id last, equal ones by their vectors), or
    all if there are fewer.  In each round every vector goes to the nearest centroid, equal distances to the smaller
    number, and every centroid that has vectors becomes the floor of their mean; then vectors are assigned once more.
    Repeated rows count each; other columns are ignored; no vector gives an empty result.  Components too large for
    exact 64-bit distances raise an error.
    """
    spark = vectors.sparkSession
    table = written(quantised(vectors.select("vec_id", "embedding"), scale, width, "vec_id"), "cluster-vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    seeds = table.orderBy(F.asc_nulls_last(order), "q").limit(k).collect()  # the centroids
    kind = table.schema["vec_id"].dataType.simpleString()
    if not seeds:
        return table.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), np.zeros((0, width), np.int64)
    c = np.array([r["q"] for r in seeds], np.int64)
    moves, kept, least = None, max(1, min(len(c) - 1, k // 4)), max(1, k // 8)
    state = f"vec_id {kind}, q array<int>, near array<int>, low array<double>, rest double, used int"
    for _ in range(rounds):
        run = _assign(spark.sparkContext.broadcast(c), moves, kept, False, ["vec_id"], width)
        before, table = table, written(table.mapInArrow(run, state), "cluster-state")
        discard(before)
        sums = np.zeros((len(c), width + 1), np.int64)
        total = table.groupBy(F.col("near")[0].alias("cluster")).agg(*(F.sum(F.col("q")[j].cast("long")) for j in range(width)), F.count("*"), F.max("used"))
        used = 0
        for r in total.collect():  # a row for each centroid
            sums[r["cluster"]] = r[1:-1]
            used = max(used, r[-1])
        new = moved(c, sums)
        if moves is not None:
            kept = min(kept, max(least, used))
        moves, c = np.sqrt(((new - c) ** 2).sum(1).astype(np.float64)) * (1 + OFF), new
    out = table.mapInArrow(_assign(spark.sparkContext.broadcast(c), moves, kept, True, ["vec_id"], width), f"vec_id {kind}, cluster int, distance long")
    return out, c


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all embeddings, with the inertia of each and of all, and a digest of its centroid."""
    rows, c = clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    rows = written(rows, "clusters")
    inertia = {r["cluster"]: r["n"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}  # a row for each centroid
    facts = [(i, n, sum(inertia.values()), hashlib.sha256(",".join(map(str, c[i].tolist())).encode()).hexdigest()) for i, n in inertia.items()]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


QUERIES = {"op12_centroid_clustering": op12_centroid_clustering}


def _sql(k: int = 40, rounds: int = 5) -> str:
    """The query round by round: all distances, sums by centroid, floors of the means."""
    parts = [
        """WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
      WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), q) - 1 AS c, q FROM v QUALIFY c < {k})",
    ]
    for r in range(rounds + 1):
        d = "list_dot_product(v.q, v.q) - 2 * list_dot_product(v.q, c.q) + list_dot_product(c.q, c.q)"
        parts.append(f"a{r} AS MATERIALIZED (SELECT rid, min(struct_pack(d := {d}, c := c.c)) AS m FROM v, c{r} c GROUP BY rid)")
        if r < rounds:
            parts.append(f"""s{r} AS (SELECT a.m.c AS c, i, floor(sum(v.q[i]) / count(*)) AS x FROM a{r} a JOIN v USING (rid), range(1, 65) t(i) GROUP BY a.m.c, i),
      c{r + 1} AS MATERIALIZED (SELECT c.c, coalesce(n.q, c.q) AS q FROM c{r} c LEFT JOIN (SELECT c, list(x ORDER BY i) AS q FROM s{r} GROUP BY c) n ON n.c = c.c)""")
    return ",\n  ".join(parts) + f"""
  SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, CAST(m.d AS BIGINT) AS distance, CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia, CAST(sum(m.d) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(list_transform(c.q, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256 FROM a{rounds} a JOIN v USING (rid) JOIN c{rounds} c ON c.c = a.m.c"""


ORACLE_SQL = {"op12_centroid_clustering": _sql()}

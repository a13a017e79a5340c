"""Vector codes: a vector is cut into parts, and each part is written as the number of its nearest codebook entry.

The codebooks are exact integers.  They are broadcast to the tasks, which compare a block of parts with all entries by
norms and one product of integer matrices and take the first of the nearest; each task sums its parts by entry, the sums
of all tasks are merged by a grouped shuffle, and the floors of the means are the codebooks of the next round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._store import written
from ._vectors import ROWS, distances, grouped_sums, matrix, moved, quantised, sound

#: Labels up to which the table of their errors is broadcast.
FEW = 100_000


def nearest(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of ``x`` [row, part, component]: the number of each part's nearest entry, the first of equal ones, and
    the squared distances summed over the parts."""
    codes, error = np.empty(x.shape[:2], np.int64), np.zeros(len(x), np.int64)
    rows = np.arange(ROWS)
    for a in range(0, len(x), ROWS):
        for p in range(x.shape[1]):
            d = distances(x[a : a + ROWS, p], books[p])
            codes[a : a + ROWS, p] = d.argmin(1)
            error[a : a + ROWS] += d[rows[: len(d)], codes[a : a + ROWS, p]]
    return codes, error


def width_of(vectors: DataFrame, parts: int) -> int | None:
    """Components of the sound vector with the smallest vec_id, if ``parts`` divides them."""
    size = F.size("embedding")
    n = vectors.where(sound(F.col("embedding").cast("array<double>")) & (size % parts == 0)).select("vec_id", size.alias("n")).orderBy(F.asc_nulls_last("vec_id"), "n").first()
    return n["n"] if n else None


def fit(kept: DataFrame, width: int, parts: int, entries: int, rounds: int) -> np.ndarray:
    """Codebooks [part, entry, component] from ``kept(vec_id, q)``: they begin as the parts of the vectors with the smallest
    vec_ids, as many as there are up to ``entries``, and are replaced ``rounds`` times by the floors of the means."""
    spark = kept.sparkSession
    seeds = kept.select("vec_id", "q").orderBy(F.asc_nulls_last("vec_id"), "q").limit(entries).collect()  # a codebook's entries
    wide = width // parts
    books = np.array([r["q"] for r in seeds], np.int64).reshape(len(seeds), parts, wide).transpose(1, 0, 2)
    n = len(seeds)
    names = ["part", "entry", *(f"s{j}" for j in range(wide)), "n"]
    for _ in range(rounds if n else 0):
        shared = spark.sparkContext.broadcast(books)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total = np.zeros((parts, n, wide + 1), np.int64)
            for batch in batches:
                x = matrix(batch.column("q"), width).reshape(-1, parts, wide)
                codes, _ = nearest(x, shared.value)
                for p in range(parts):
                    total[p] += grouped_sums(x[:, p], codes[:, p], n)
            part, entry = np.nonzero(total[:, :, -1])
            found = total[part, entry]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), *(pa.array(found[:, j]) for j in range(wide + 1))], names=names)

        sums = kept.select("q").mapInArrow(run, ", ".join(f"{c} long" for c in names))
        merged = np.zeros((parts, n, wide + 1), np.int64)
        for r in sums.groupBy("part", "entry").agg(*(F.sum(c).alias(c) for c in names[2:])).collect():  # a row for each entry
            merged[r["part"], r["entry"]] = r[2:]
        books = np.stack([moved(books[p], merged[p]) for p in range(parts)])
        shared.unpersist()
    return books


def encode(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """``kept`` with ``code``, two hex digits for each part, and ``error``, the squared distance from what the code stands for."""
    parts, _, wide = books.shape
    shared = kept.sparkSession.sparkContext.broadcast(books)
    schema = T.StructType([*kept.schema, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, error = nearest(matrix(batch.column("q"), parts * wide).reshape(-1, parts, wide), shared.value)
            text, step = codes.astype(np.uint8).tobytes().hex(), 2 * parts
            texts = [text[i : i + step] for i in range(0, len(text), step)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string()), pa.array(error)], names=schema.names)

    return kept.mapInArrow(run, schema)


def decode(coded: DataFrame, books: np.ndarray) -> DataFrame:
    """``coded`` with ``q``, the entries that ``code`` names one after the other; a null code gives null."""
    shared = coded.sparkSession.sparkContext.broadcast(books)
    coded = coded.drop("q")
    schema = T.StructType([*coded.schema, T.StructField("q", T.ArrayType(T.IntegerType()))])
    parts = np.arange(books.shape[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [None if c is None else np.frombuffer(bytes.fromhex(c), np.uint8) for c in batch.column("code").to_pylist()]
            lists = [None if c is None else shared.value[parts, c].ravel().tolist() for c in codes]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int32()))], names=schema.names)

    return coded.mapInArrow(run, schema)


def compressed(vectors: DataFrame, *, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> tuple[DataFrame, np.ndarray]:
    """``vec_id``, ``label``, ``code`` and ``error`` of each vector of ``vectors(vec_id, embedding, label)`` that is kept, and the
    codebooks as integers of ``scale`` times the components.

    Vectors that are null or empty, or hold null or non-finite components, are dropped.  All vectors have as many components,
    which ``parts`` divides: those that have not as many as the kept vector with the smallest vec_id are dropped, too.  Null
    vec_ids come last among the first entries, equal ones by their vectors.  With fewer vectors than ``entries`` the codebooks
    have an entry for each; without any the result is empty.  Repeated rows have a row each.  Labels of any type pass
    through, other columns are ignored.  Components too large for exact 64-bit distances (2 ** 18 and more at 64 components)
    raise an error.
    """
    if entries > 256:
        raise ValueError("a code has one byte for each part")
    vectors = vectors.select("vec_id", "embedding", "label")
    width = width_of(vectors, parts)
    if width is None:
        nothing = vectors.where("false").select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return nothing, np.zeros((parts, 0, 0), np.int64)
    kept = written(quantised(vectors, scale, width, "vec_id", "label"), "code-vectors")
    books = fit(kept, width, parts, entries, rounds)
    return encode(kept, books).drop("q"), books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components as decimal integers joined by commas: by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings, with the error of each and that of its label; null labels count together."""
    rows, books = compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    rows = written(rows, "vector-codes")
    by_label = written(rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    by_label = F.broadcast(by_label) if by_label.count() <= FEW else by_label
    out = rows.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


QUERIES = {"op13_vector_codes": op13_vector_codes}


def _sql(entries: int = 256, rounds: int = 4) -> str:
    """The query round by round: all distances of parts, sums by entry, floors of the means."""
    parts = [
        """WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q FROM embeddings
      WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding))""",
        "x AS MATERIALIZED (SELECT rid, p, q[p * (len(q) // 4) + 1 : (p + 1) * (len(q) // 4)] AS s FROM v, range(4) t(p))",
        f"f AS (SELECT rid, row_number() OVER (ORDER BY vec_id, q) - 1 AS e FROM v QUALIFY e < {entries})",
        "b0 AS MATERIALIZED (SELECT p, e, s FROM x JOIN f USING (rid))",
    ]
    for r in range(rounds + 1):
        d = "list_dot_product(x.s, x.s) - 2 * list_dot_product(x.s, b.s) + list_dot_product(b.s, b.s)"
        parts.append(f"a{r} AS MATERIALIZED (SELECT rid, x.p AS p, min(struct_pack(d := {d}, e := b.e)) AS m FROM x JOIN b{r} b ON b.p = x.p GROUP BY rid, x.p)")
        if r < rounds:
            parts.append(f"""s{r} AS (SELECT a.p AS p, a.m.e AS e, i, floor(sum(x.s[i]) / count(*)) AS y FROM a{r} a JOIN x ON x.rid = a.rid AND x.p = a.p, range(1, 17) t(i) GROUP BY a.p, a.m.e, i),
      b{r + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(n.s, b.s) AS s FROM b{r} b LEFT JOIN (SELECT p, e, list(y ORDER BY i) AS s FROM s{r} GROUP BY p, e) n ON n.p = b.p AND n.e = b.e)""")
    return ",\n  ".join(parts) + f""",
  g AS (SELECT rid, string_agg(format('{{:02x}}', m.e), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a{rounds} GROUP BY rid)
  SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(array_to_string(list_transform(s, lambda y: CAST(y AS BIGINT)), ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256 FROM g JOIN v USING (rid)"""


ORACLE_SQL = {"op13_vector_codes": _sql()}

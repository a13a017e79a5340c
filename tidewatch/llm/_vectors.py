"""Vectors as exact integers, and their squared distances."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that a task works on at once.
ROWS = 4096


def sound(embedding: Column) -> Column:
    """Whether a vector is there, has components, and all of them are finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.coalesce(F.forall(embedding, finite) & (F.size(embedding) > 0), F.lit(False))


def most(width: int) -> int:
    """The largest size of integer components whose squared distances of ``width`` components are sure to fit 64 bits."""
    return min(2**31 - 1, int((2**63 // (4 * max(1, width))) ** 0.5) - 1)


def quantised(vectors: DataFrame, scale: int, width: int, *columns: str) -> DataFrame:
    """``columns`` and ``q``, floor(scale * x) of each component x as double, of the vectors of ``width`` components that are
    sound.  A component whose integer is too large for exact distances raises an error, as overflow does."""
    wide = vectors.select(*columns, F.col("embedding").cast("array<double>").alias("_x")).where(sound(F.col("_x")) & (F.size("_x") == width))
    whole = lambda x: F.floor(x * float(scale))
    fits = lambda x: F.abs(x) < F.lit(most(width) / scale)
    q = F.when(F.forall("_x", fits), F.transform("_x", lambda x: whole(x).cast("int"))).otherwise(F.raise_error(F.lit("a component is too large for exact distances")))
    return wide.select(*columns, q.alias("q"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of ``width`` integers as rows of a matrix."""
    return column.flatten().to_numpy().astype(np.int64).reshape(len(column), width)


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``x`` and of ``c``, exactly: norms less twice the product, in 64-bit integers."""
    return (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)


def grouped_sums(x: np.ndarray, of: np.ndarray, groups: int) -> np.ndarray:
    """For each of ``groups`` the sum of its rows of ``x`` and, last, their count."""
    out = np.zeros((groups, x.shape[1] + 1), np.int64)
    if len(x):
        order = np.argsort(of, kind="stable")
        first = np.flatnonzero(np.append(True, of[order][1:] != of[order][:-1]))
        out[of[order][first], :-1] = np.add.reduceat(x[order], first)
        out[:, -1] = np.bincount(of, minlength=groups)
    return out


def moved(centres: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """The componentwise floor of each group's mean; a group without rows stays where it was."""
    n = sums[:, -1:]
    return np.where(n > 0, sums[:, :-1] // np.maximum(n, 1), centres)

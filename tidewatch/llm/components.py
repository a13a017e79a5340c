"""Connected components of a graph of links, by contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node it reaches, for every node of ``links(a long, b long)``.

    In each round every node moves to the neighbour of the smallest hash, itself included, and links are drawn anew
    between the places moved to; a constant share of the nodes goes, so rounds grow with the logarithm.  Nodes are never
    collected: a hub's links are aggregated before the shuffle.  Loops and repeated links do no harm; nulls are ignored.
    """
    rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
    links = links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a is not null and b is not null")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    left = written(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    place = nodes.select("node", F.col("node").alias("at"))
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        moves = both.groupBy("a").agg(F.min(rank("b")).alias("r"))
        moves = written(moves.select(F.col("a").alias("from"), F.least("r", rank("a"))["id"].alias("to")), "moves")
        place = place.join(moves, F.col("at") == F.col("from"), "left").select("node", F.coalesce("to", "at").alias("at"))
        ends = left
        for side in ("a", "b"):
            ends = ends.join(moves, F.col(side) == F.col("from")).withColumn(side, F.col("to")).drop("from", "to")
        ends = ends.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        left = written(ends, "links")
    place = written(place, "places")
    least = place.groupBy("at").agg(F.min("node").alias("component"))
    return place.join(least, "at").select("node", "component")


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For nodes 0 to n-1: those that links reach, and the least node each reaches."""
    least = np.arange(n)
    while True:
        new = least.copy()
        np.minimum.at(new, a, least[b])
        np.minimum.at(new, b, least[a])
        new = new[new]
        if (new == least).all():
            return np.flatnonzero(least != np.arange(n)), least
        least = new

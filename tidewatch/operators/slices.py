"""Work along an order without one task for all of it: numbers, and values that are carried along a key's history.

Numbers: rows are range-partitioned by the order and written once, counted by partition, and numbered from there.

Carried values: keys are counted first.  One with more rows than a task should hold is cut into slices at quantiles of its
time; all others are one slice, and are shuffled once.  What a slice knows by itself is computed slice by slice; what goes
from slice to slice is a row for each slice of the cut keys.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import stored

#: Name of a row's slice: -1 where its key is one.
SLICE = "_slice"
#: Rows of a key from which on it is cut, and slices of a key at most.
SLICE_ROWS, MOST_SLICES = 1_000_000, 256
#: Cut keys up to which what is known of their slices is broadcast.
FEW = 1_000


def numbered(df: DataFrame, order: list[str], name: str = "id", start: int = 1) -> DataFrame:
    """``df`` with numbers from ``start`` in the order of its columns, nulls first: counts by range, then each from its own on."""
    at = F.monotonically_increasing_id()  # the partition's number, and 33 bits for the place in it
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(ranged.withColumns({"_range": F.shiftright(at, 33), "_place": at.bitwiseAND(F.lit((1 << 33) - 1))}), "ranges")
    counts = sorted(tuple(r) for r in rows.groupBy("_range").count().collect())  # a row for each partition
    first = [(s, start + sum(n for _, n in counts[:i])) for i, (s, _) in enumerate(counts)]
    first = df.sparkSession.createDataFrame(first, "_range long, _first long")
    return rows.join(F.broadcast(first), "_range").withColumn(name, F.col("_first") + F.col("_place")).drop("_range", "_place", "_first")


def _on(keys: list[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys))


@dataclass
class Slices:
    """``rows`` with their slice.  ``cut`` is how many keys have several."""

    rows: DataFrame
    keys: list[str]
    cut: int

    def by_slice(self) -> list[str]:
        return [*self.keys, SLICE]

    def joined(self, small: DataFrame, on: list[str], *columns: str) -> DataFrame:
        """``rows`` with columns of a table of the cut keys or their slices, null for others."""
        side = small.select(*(F.col(k).alias(f"_s{k}") for k in on), *columns)
        return self.rows.join(F.broadcast(side) if self.cut <= FEW else side, _on(on, "_s"), "left").drop(*(f"_s{k}" for k in on))

    def with_carried(self, ends, value: Column, *, backward: bool = False) -> Slices:
        """With ``_carried``, what the slices before (``backward``: after) hand to a row's slice: of what ``ends`` makes of the
        cut keys' rows, a row for each key and slice, the nearest ``value`` that is not null."""
        if not self.cut:
            kind = ends(self.rows).select(value.alias("v")).schema["v"].dataType
            return Slices(self.rows.withColumn("_carried", F.lit(None).cast(kind)), self.keys, 0)
        order = F.col(SLICE).desc() if backward else F.col(SLICE)
        w = Window.partitionBy(*self.keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)  # MOST_SLICES rows each
        carry = ends(self.rows.where(F.col(SLICE) >= 0)).withColumn("_carried", F.last(value, ignorenulls=True).over(w)).where("_carried is not null")
        return Slices(self.joined(carry, self.by_slice(), "_carried"), self.keys, self.cut)


def sliced(df: DataFrame, keys: list[str], time: str) -> Slices:
    """``df`` with its keys cut into slices of time, a column of numbers or times; a null is in the first slice, and rows of one
    time share a slice."""
    hot = stored(df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > SLICE_ROWS), "hot-keys")
    cut, most = hot.agg(F.count("*"), F.max("_n")).first()
    if not cut:
        return Slices(df.withColumn(SLICE, F.lit(-1)), keys, 0)
    parts = min(MOST_SLICES, -(-most // SLICE_ROWS) * 2)
    whole = Slices(df, keys, cut)
    marked = whole.joined(hot, keys, "_n").where("_n is not null").groupBy(*keys)
    bounds = stored(marked.agg(F.percentile_approx(time, [i / parts for i in range(1, parts)], 100 * parts).alias("_bounds")), "slice-bounds")
    place = F.size(F.filter("_bounds", lambda b: b < F.col(time)))
    out = whole.joined(bounds, keys, "_bounds").withColumn(SLICE, F.when(F.col("_bounds").isNull(), -1).otherwise(F.coalesce(place, F.lit(0))))
    return Slices(out.drop("_bounds"), keys, cut)


def last_known(df: DataFrame, keys: list[str], order: list[str], value: str, name: str, *, backward: bool = False, strict: bool = False) -> DataFrame:
    """``df`` with ``name``, the last ``value`` of the key that is not null up to each row (``strict``: before it), in the order of
    the columns ``order``, of which the first is a time or number; ``backward``: the first one from each row on."""
    s = sliced(df, keys, order[0])
    by = [F.col(o).desc_nulls_last() if backward else F.col(o).asc_nulls_first() for o in order]
    own = Window.partitionBy(*s.by_slice()).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
    nearest = (F.min_by if backward else F.max_by)(value, F.when(F.col(value).isNotNull(), F.struct(*order)))
    s = s.with_carried(lambda rows: rows.groupBy(*s.by_slice()).agg(nearest.alias("_end")), F.col("_end"), backward=backward)
    return s.rows.withColumn(name, F.coalesce(F.last(value, ignorenulls=True).over(own), F.col("_carried"))).drop("_carried", SLICE)

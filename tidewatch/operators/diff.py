"""Snapshot comparison: changes, removals and the append-only change log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import slices


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _on(keys: list[str], prefix: str, nulls: bool) -> Column:
    """Equal keys; without ``nulls`` they are taken to have none, and columns are compared as they are, which is what
    tables laid out by their keys need to be joined in place."""
    return reduce(lambda a, b: a & b, (same(F.col(k), F.col(f"{prefix}{k}")) if nulls else F.col(k) == F.col(f"{prefix}{k}") for k in keys))


def without(df: DataFrame, other: DataFrame, keys: list[str], *, nulls: bool = True) -> DataFrame:
    """Rows of ``df`` whose key ``other`` hasn't; null keys equal null keys (without ``nulls`` there are none)."""
    there = other.select(*(F.col(k).alias(f"_o_{k}") for k in keys))
    return df.join(there, _on(keys, "_o_", nulls), "left_anti")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that several rows have, and how many."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` itself; an action on the result fails if several rows have the same key.

    The check is part of the plan (a count over the key's rows, which are together for the join anyway), so it costs no
    job of its own.
    """
    n = F.count("*").over(Window.partitionBy(*keys))
    message = F.concat(F.lit("several rows have the key "), F.to_json(F.struct(*keys)))
    return df.withColumn("_n", n).where(F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(True)).drop("_n")


def latest_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The last row of each key by ``order``."""
    w = Window.partitionBy(*keys).orderBy(*(c.desc() for c in order))
    return df.withColumn("_i", F.row_number().over(w)).where("_i = 1").drop("_i")


def first_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key by ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_i", F.row_number().over(w)).where("_i = 1").drop("_i")


def snapshot_diff(prev: DataFrame, cur: DataFrame, keys: list[str], features: list[str], *, removed: bool = True, unchanged: bool = False, places: dict[str, int] | None = None, nulls: bool = True) -> DataFrame:
    """Keys, features, features before (``prev_*``) and ``change``: new, changed, removed or unchanged.

    Null keys equal null keys (without ``nulls`` there are none) and null features null features.  Removed rows have null features; a single full outer join
    makes all of them.  Features in ``places`` are compared rounded to so many decimals.
    """
    shown = lambda c, f: F.round(c, places[f]) if places and f in places else F.col(c)
    p = prev.select(*(F.col(k).alias(f"_p_{k}") for k in keys), *(F.col(f).alias(f"prev_{f}") for f in features), F.lit(True).alias("_in_p"))
    c = cur.select(*keys, *features, F.lit(True).alias("_in_c"))
    differs = reduce(lambda a, b: a | b, (~same(shown(f, f), shown(f"prev_{f}", f)) for f in features))
    change = F.when(F.col("_in_p").isNull(), "new").when(F.col("_in_c").isNull(), "removed").when(differs, "changed").otherwise("unchanged")
    out = c.join(p, _on(keys, "_p_", nulls), "full_outer").withColumn("change", change)
    out = out.select(*(F.when(F.col("_in_c").isNull(), F.col(f"_p_{k}")).otherwise(F.col(k)).alias(k) for k in keys), *features, *(f"prev_{f}" for f in features), "change")
    out = out if removed else out.where("change <> 'removed'")
    return out if unchanged else out.where("change <> 'unchanged'")


def removed_rows(prev: DataFrame, cur: DataFrame, keys: list[str], features: list[str], *, nulls: bool = True) -> DataFrame:
    """Deletion markers: keys of ``prev`` that ``cur`` hasn't, with features 0 and ``Ceased`` true."""
    gone = without(prev, cur, keys, nulls=nulls)
    return gone.select(*keys, *(F.lit(0).cast(prev.schema[f].dataType).alias(f) for f in features), F.lit(True).alias("Ceased"))


def changed_rows(prev: DataFrame, cur: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """Rows of ``cur`` that are new or differ from ``prev``: a left join, without removals."""
    return snapshot_diff(prev, cur, keys, features, removed=False).select(*keys, *features)


def published_changes(prev: DataFrame, cur: DataFrame, keys: list[str], features: list[str], *, emit_removed: bool = True) -> DataFrame:
    """What a tick appends to the change log: changed rows and, if wanted, deletion markers."""
    changed = changed_rows(prev, cur, keys, features).withColumn("Ceased", F.lit(False))
    return changed.unionByName(removed_rows(prev, cur, keys, features)) if emit_removed else changed


def change_log(ticks: DataFrame, keys: list[str], features: list[str], *order: str) -> DataFrame:
    """Of a history of snapshots, the first row of each key and those that differ from the one before.  A long history is
    compared in slices; the first row of a slice is compared with the last one of the slice before."""
    state, s = F.struct(*features), slices.sliced(ticks, keys, order[0])
    w = Window.partitionBy(*s.by_slice()).orderBy(*order)
    last = F.max_by(state, F.struct(*order)).alias("_end")
    s = s.with_carried(lambda rows: rows.groupBy(*s.by_slice()).agg(last), F.col("_end"))
    out = s.rows.withColumn("_before", F.coalesce(F.lag(state).over(w), F.col("_carried")))
    return out.where(F.col("_before").isNull() | ~same(state, F.col("_before"))).select(ticks.columns)


def applied(prev: DataFrame, changes: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """The snapshot that ``changes`` (with ``Ceased``) make of ``prev``."""
    rest = without(prev, changes, keys).select(*keys, *features)
    return rest.unionByName(changes.where(~F.coalesce("Ceased", F.lit(False))).select(*keys, *features))

"""Lookup tables: selectors of known keys, what goes with what, zones of regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import slices


def selector_union(known: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """All keys ever seen, each once; rows with a null are left out."""
    return known.select(*keys).unionByName(new.select(*keys)).dropna("any").distinct()


def association(df: DataFrame, by: str, *others: str) -> DataFrame:
    """For each value the sorted distinct values of other columns; the text nan is none."""
    sets = (F.array_sort(F.collect_set(F.when(F.col(c) != "nan", F.col(c)))).alias(c) for c in others)
    return df.where(F.col(by) != "nan").groupBy(by).agg(*sets)


def value_map(df: DataFrame, key: Column, value: Column, *by: str) -> DataFrame:
    """Keys and values of a table's rows as one map (for each ``by``): for small lookup tables.  A key may be a struct of
    columns; of a key's several values the greatest stays."""
    pairs = df.select(*by, key.alias("_k"), value.alias("_v")).where("_k is not null").groupBy(*by, "_k").agg(F.max("_v").alias("_v"))
    return pairs.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_k", "_v")))).alias("map"))


def flattened(pages: DataFrame, items: str) -> DataFrame:
    """A row for each item of a column of lists; other columns are repeated, empty and null lists have none."""
    return pages.withColumn(items, F.explode(items))


def zone_regions(zones: DataFrame, regions: DataFrame) -> DataFrame:
    """Region of each zone id, prefix-n: the prefix is derived on both sides and compared, so this is an equi-join."""
    prefixed = regions.select("Region", S.zone_prefix(F.col("Region")).alias("_prefix")).where("_prefix is not null")
    return zones.withColumn("_prefix", F.regexp_extract("ZoneId", "^(.*)-[^-]*$", 1)).join(prefixed, "_prefix").drop("_prefix")


def starts_with_join(left: DataFrame, name: str, right: DataFrame, prefix: str) -> DataFrame:
    """Pairs where a name starts with a prefix of at least one character.

    Every name offers its prefixes of the lengths that occur, so it is an equi-join rather than a comparison of all pairs.
    """
    lengths = F.broadcast(right.select(F.length(prefix).alias("_n")).where("_n > 0").distinct())  # lengths of names: few
    offered = left.crossJoin(lengths).where(F.length(name) >= F.col("_n")).withColumn("_prefix", F.substr(F.col(name), F.lit(1), F.col("_n")))
    return offered.join(right, F.col("_prefix") == F.col(prefix)).drop("_prefix", "_n")


def replaced(df: DataFrame, column: str, mapping: DataFrame, key: str, value: str) -> DataFrame:
    """The column with mapped values; those without one stay."""
    pairs = mapping.select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    return df.join(pairs, F.col(column) == F.col("_k"), "left").withColumn(column, F.coalesce("_v", column)).drop("_k", "_v")


def asof_forward(left: DataFrame, right: DataFrame, keys: list[str], time: str = "ts") -> DataFrame:
    """Rows of ``left`` with the first time of ``right`` strictly after theirs, ``next_ts``; those without one are dropped.

    Both sides go through one order, so no pair is compared; a key with very many rows is read in slices.
    """
    both = left.withColumn("_right", F.lit(None).cast(right.schema[time].dataType)).unionByName(
        right.select(*keys, time, F.col(time).alias("_right")), allowMissingColumns=True
    )
    # at one time the right side's rows come first, so that those after a row of the left side are strictly later
    both = both.withColumn("_left", F.col("_right").isNull())
    out = slices.last_known(both, keys, [time, "_left"], "_right", "next_ts", backward=True, strict=True)
    return out.where("_left and next_ts is not null").drop("_right", "_left")

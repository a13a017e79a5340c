"""Sharding by sampled splitters: range partitioning of records into shards of near equal bytes.

Keys of records are sampled in proportion to their size, quantiles of the sample become the boundaries of fine
ranges, exact sizes are counted by range, and a range that is overfull is subdivided by a second key.  The shards
are then stretches of equal bytes of that order, so the sample decides only how evenly the work is dealt.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._store import written

#: Draws of the sample for each range, and ranges at most; beyond them ranges are overfull and subdivided.
DRAWS, MOST_RANGES = 32, 4096
#: Rows that a unit of work, a range or a part of one, is planned to have; units up to which their table is broadcast.
RANGE_ROWS, FEW = 500_000, 200_000
#: A range that holds more than so many times the mean is subdivided.
OVERFULL = 2.0


def _searched(key: Column, splitters: list[int]) -> Column:
    """How many splitters are at most the key: by blocks of about the square root, then within one."""
    if not splitters:
        return F.lit(0)
    step = max(1, math.isqrt(len(splitters)))
    blocks = [splitters[i : i + step] for i in range(0, len(splitters), step)]
    heads = F.lit([b[0] for b in blocks])
    full = F.size(F.filter(heads, lambda s: s <= key))
    within = F.get(F.lit([b + [(1 << 63) - 1] * (step - len(b)) for b in blocks]), full - 1)
    return F.when(full == 0, 0).otherwise((full - 1) * step + F.size(F.filter(within, lambda s: s <= key)))


def _quantiles(sample: list[tuple[int, int]], ranges: int) -> list[int]:
    """Keys that cut a sample of (key, draws) into as many ranges of about equal draws."""
    total, seen, out = sum(n for _, n in sample), 0, []
    for value, n in sorted(sample):
        if seen and len(out) < seen * ranges // total:
            out.append(value)
        seen += n
    return out


def shard_by_bytes(rows: DataFrame, shards: int, *, key: str = "key", tie: str = "tie", size: str = "size", ranges: int | None = None) -> DataFrame:
    """``rows`` with ``shard`` int and ``slot`` long, gapless from 0 in each shard.

    Sizes of two shards differ by less than the largest record and equal keys are neighbours, so a key is in two shards only
    where the boundary falls within it.  ``key`` and ``tie`` are longs (null sorts as the smallest); records equal in key
    and tie follow each other in any order.  A null size counts 0.  An empty table gives an empty table.  Names of other
    columns must not begin with ``_shard``.

    An overfull range is subdivided by a hash of its keys, and a key that is overfull by itself by its ties.  The sample
    has ``DRAWS`` keys for each of at most ``MOST_RANGES`` ranges, whatever the number of rows.
    """
    rows = rows.withColumns({key: F.coalesce(F.col(key), F.lit(-(1 << 63))), size: F.coalesce(F.col(size), F.lit(0)).cast("long")})
    n, total = rows.agg(F.count("*"), F.sum(size)).first()
    if not n:
        return rows.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")})
    total = max(int(total), 1)
    units = ranges or max(64 * shards, math.ceil(n / RANGE_ROWS))
    unit_size, ranges = total / units, min(units, MOST_RANGES)
    draws = DRAWS * ranges
    # Poisson sampling: a record is drawn with probability draws * size / total, by a hash of its keys
    drawn = F.pmod(F.xxhash64(F.lit("draw"), key, tie), F.lit(1 << 40)) / float(1 << 40) * total < F.col(size) * float(draws)
    sample = rows.where(drawn).groupBy(key, tie).count().groupBy(key).agg(F.sum("count")).collect()
    splitters = _quantiles([tuple(r) for r in sample], ranges)
    dealt = rows.withColumn("_shard_range", _searched(F.col(key), splitters))
    held = dealt.groupBy("_shard_range").agg(F.sum(size).alias("b")).where(F.col("b") > OVERFULL * unit_size)
    parts = {int(r["_shard_range"]): math.ceil(r["b"] / unit_size) for r in held.collect()}  # a row for each range at most
    part, sub = F.lit(0), F.lit(0)
    if parts:
        count = F.coalesce(F.get(F.lit([parts.get(i, 1) for i in range(len(splitters) + 1)]), F.col("_shard_range")), F.lit(1))
        dealt = dealt.withColumn("_shard_parts", count)
        hot = dealt.where("_shard_parts > 1").groupBy(F.col(key).alias("_shard_hot")).agg(F.sum(size).alias("b")).where(F.col("b") > OVERFULL * unit_size)
        hot = hot.select("_shard_hot", F.ceil(F.col("b") / unit_size).alias("_shard_subs"))  # at most units / OVERFULL rows
        dealt = dealt.join(F.broadcast(hot) if units < FEW else hot, F.col(key) == F.col("_shard_hot"), "left")
        part = F.pmod(F.xxhash64(F.lit("part"), key), F.col("_shard_parts")).cast("int")
        sub = F.coalesce(1 + F.pmod(F.xxhash64(F.lit("sub"), tie), F.col("_shard_subs")), F.lit(0)).cast("int")
    unit = ["_shard_range", "_shard_part", "_shard_sub"]
    dealt = dealt.withColumns({"_shard_part": part, "_shard_sub": sub}).drop("_shard_parts", "_shard_hot", "_shard_subs")
    order = Window.partitionBy(*unit).orderBy(key, tie, size)
    placed = dealt.withColumns({"_shard_end": F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)), "_shard_row": F.row_number().over(order).cast("long")})
    sizes = dealt.groupBy(*unit).agg(F.sum(size).alias("_shard_bytes"))
    before = F.sum("_shard_bytes").over(Window.orderBy(*unit)) - F.col("_shard_bytes")  # a row for each unit only
    starts = sizes.select(*unit, before.alias("_shard_start"))
    few = units + sum(parts.values()) < FEW
    middle = F.col("_shard_start") + F.col("_shard_end") - F.col(size) / 2
    placed = placed.join(F.broadcast(starts) if few else starts, unit)
    placed = placed.withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle / total * shards)).cast("int"))
    runs = placed.groupBy("shard", *unit).agg(F.count("*").alias("_n"), F.min("_shard_row").alias("_first"))
    ahead = F.sum("_n").over(Window.partitionBy("shard").orderBy(*unit)) - F.col("_n") - F.col("_first")
    runs = runs.select("shard", *unit, ahead.alias("_shard_ahead"))
    out = placed.join(F.broadcast(runs) if few else runs, ["shard", *unit])
    return out.withColumn("slot", F.col("_shard_row") + F.col("_shard_ahead")).drop(*unit, "_shard_start", "_shard_end", "_shard_row", "_shard_ahead")


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Shards of ``docs(doc_id, text)`` by bytes; equal texts are neighbours, so they share a shard unless a boundary falls
    among them.  A null text has size 1, as an empty one; other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("key"), F.xxhash64("doc_id").alias("tie"),
    )
    out = shard_by_bytes(written(rows, "shard-keys"), shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), 8)


QUERIES = {"op7_sharding": op7_sharding}

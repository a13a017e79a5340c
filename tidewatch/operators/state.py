"""Capacity state: the largest node counts known to get a high or medium score, carried from tick to tick."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import CAPACITIES
from . import slices

#: The next smaller capacity that is asked for.
FALLBACK = dict(zip(CAPACITIES, (*CAPACITIES[1:], 0), strict=True))


def tick_levels(score: Column, capacity: Column, *, medium_is_high: bool = False) -> tuple[Column, Column]:
    """T3 and T2 that one tick alone shows.  With ``medium_is_high`` a high score counts for T2, too."""
    t3 = F.when(score >= 3, capacity).otherwise(0)
    t2 = F.when((score >= 2) if medium_is_high else (score == 2), capacity).otherwise(0)
    return t3, t2


def step(score: Column, t3: Column, t2: Column, capacity: Column, prev_score: Column, prev_t3: Column, prev_t2: Column) -> tuple[Column, Column, Column]:
    """Score, T3 and T2 after a tick, from those of the tick and those before (null: none).

    A capacity that is reached raises the level; one that fails lowers it under that capacity.  The single-node score is the
    one that is kept; ticks of several nodes can only raise it, and it clears levels it contradicts.  A single-node tick
    without a score counts with the score before; ticks of several nodes without one count as failed.
    """
    zero = F.lit(0)
    p3, p2 = F.coalesce(prev_t3, zero), F.coalesce(prev_t2, zero)
    single = capacity == 1
    known = F.when(single, F.coalesce(score, prev_score)).otherwise(score)
    below = F.coalesce(F.create_map(*(F.lit(x) for pair in FALLBACK.items() for x in pair))[capacity], zero)
    up3 = F.when(known >= 3, F.greatest(F.coalesce(t3, zero), p3)).otherwise(F.least(below, p3))
    up2 = F.when(known >= 2, F.greatest(F.coalesce(t2, zero), p2)).otherwise(F.least(below, p2))
    kept = F.when(single, known).otherwise(F.greatest(prev_score, score))
    return kept, F.when(kept <= 2, zero).otherwise(up3), F.when(kept < 2, zero).otherwise(up2)


def capacity_step(prev: DataFrame, cur: DataFrame, keys: list[str], score: str = "SPS", unknown: int | None = None) -> DataFrame:
    """``cur`` (keys, score, T3, T2, TargetCapacity) with the state of ``prev`` carried on: one left join.  With ``unknown`` a null
    score of either is that number, as some sources write it; a key that ``prev`` hasn't has none."""
    known = F.col(score) if unknown is None else F.coalesce(F.col(score), F.lit(unknown))
    p = prev.select(*keys, known.alias("_s"), F.col("T3").alias("_t3"), F.col("T2").alias("_t2"))
    out = cur.withColumn(score, known).join(p, keys, "left")
    new = step(*(F.col(c) for c in (score, "T3", "T2", "TargetCapacity", "_s", "_t3", "_t2")))
    return out.withColumns({score: new[0].cast("int"), "T3": new[1].cast("int"), "T2": new[2].cast("int")}).drop("_s", "_t3", "_t2")


#: Ticks of a key that are folded at once, and limits that no level reaches.
CHUNK, LOW, HIGH = 1_000, -1, 1_000


def _composed(steps: Column) -> Column:
    """The steps of an array, each of which moves a level into its bounds, one after the other: again such a step."""

    def after(one: Column, two: Column) -> Column:
        within = lambda x, t: F.greatest(two[f"lo{t}"], F.least(two[f"hi{t}"], x))
        return F.struct(*(within(one[f"{side}{t}"], t).alias(f"{side}{t}") for t in (3, 2) for side in ("lo", "hi")))

    none = F.struct(*(F.lit(v).alias(f"{side}{t}") for t in (3, 2) for side, v in (("lo", LOW), ("hi", HIGH))))
    return F.aggregate(steps, none, after)


def capacity_fold(ticks: DataFrame, keys: list[str], order: list[str], score: str = "score", capacity: str = "capacity", initial: DataFrame | None = None) -> DataFrame:
    """Each key's state after all its ticks, in order, however many of the ticks are of one key; from ``initial``, states
    (keys, ``sps``, ``t3``, ``t2``) before the first tick, which those keys keep that have no ticks.

    The score that is kept is a running maximum since the last single-node score: a slice of the order knows it by itself
    from its first single-node score on, and before that from its own ticks and the score carried into it.  Given it, a tick
    moves a level into bounds, and so do several ticks together: they are folded ``CHUNK`` at a time, then the chunks of a
    slice, then the slices.
    """
    sl, at = slices.SLICE, F.struct(*order)
    ticks = ticks.select(*keys, *order, F.col(score).cast("int").alias("_s"), F.col(capacity).cast("int").alias("_c"))
    levels = {t: F.lit(None).cast("int").alias(f"_t{t}") for t in (3, 2)}
    ticks = ticks.select("*", *levels.values())
    if initial is not None:  # a single-node score without a time, before all others, that sets the levels
        first = initial.select(*keys, F.col("sps").cast("int").alias("_s"), F.lit(1).alias("_c"), *(F.coalesce(f"t{t}", F.lit(0)).cast("int").alias(f"_t{t}") for t in (3, 2)))
        ticks = ticks.unionByName(first, allowMissingColumns=True)
    cut = slices.sliced(ticks, keys, order[0])
    w = Window.partitionBy(*keys, sl).orderBy(*order)
    so_far = (Window.unboundedPreceding, 0)
    single, s = F.col("_c") == 1, F.col("_s")
    cut.rows = cut.rows.withColumns({"_since": F.count_if(single & s.isNotNull()).over(w.rowsBetween(*so_far)), "_chunk": F.floor((F.row_number().over(w) - 1) / CHUNK)})
    cut.rows = cut.rows.withColumn("_local", F.max("_s").over(Window.partitionBy(*keys, sl, "_since").orderBy(*order).rowsBetween(*so_far)))

    def ends(rows: DataFrame) -> DataFrame:
        """The score kept after each slice: one with a single-node score begins anew, others go on with what was kept before."""
        out = rows.groupBy(*keys, sl).agg(F.max("_since").alias("_n"), F.max_by("_local", at).alias("_end"))
        out = out.withColumn("_run", F.count_if(F.col("_n") > 0).over(Window.partitionBy(*keys).orderBy(sl).rowsBetween(*so_far)))
        return out.withColumn("_end", F.max("_end").over(Window.partitionBy(*keys, "_run").orderBy(sl).rowsBetween(*so_far)))

    rows = cut.with_carried(ends, F.col("_end")).rows
    rows = rows.withColumn("_kept", F.when(F.col("_since") > 0, F.col("_local")).otherwise(F.greatest("_local", "_carried")))
    rows = rows.withColumn("_known", F.when(single, F.coalesce(s, F.lag("_kept").over(w), F.col("_carried"))).otherwise(s))
    below = F.coalesce(F.create_map(*(F.lit(x) for pair in FALLBACK.items() for x in pair))[F.col("_c")], F.lit(0))
    bounds = []
    for t, level, cleared in ((3, tick_levels(s, F.col("_c"))[0], F.col("_kept") <= 2), (2, tick_levels(s, F.col("_c"))[1], F.col("_kept") < 2)):
        up = F.col("_known") >= t
        given = F.when(F.col(f"_t{t}").isNotNull(), F.col(f"_t{t}"))
        bounds += [given.when(cleared, 0).when(up, level).otherwise(LOW).alias(f"lo{t}"), given.when(cleared, 0).when(up, HIGH).otherwise(below).alias(f"hi{t}")]
    now = rows.select(*keys, sl, "_chunk", at.alias("_at"), F.col("_kept").alias("_last"), F.struct(*bounds).alias("_step"))
    for by, place in (([*keys, sl, "_chunk"], "_at"), ([*keys, sl], "_chunk"), (keys, sl)):
        steps = F.transform(F.array_sort(F.collect_list(F.struct(place, "_step"))), lambda x: x["_step"])
        now = now.groupBy(*by).agg(steps.alias("_steps"), F.max_by("_last", place).alias("_last"))
        now = now.select(*by, "_last", _composed(F.col("_steps")).alias("_step"))
    level = lambda t: F.greatest(F.col(f"_step.lo{t}"), F.least(F.col(f"_step.hi{t}"), F.lit(0))).cast("int").alias(f"t{t}")
    return now.select(*keys, F.col("_last").alias("sps"), level(3), level(2))


def backfilled(before: DataFrame, after: DataFrame, ticks: DataFrame, late: DataFrame, keys: list[str], order: list[str], score: str = "score", capacity: str = "capacity") -> DataFrame:
    """``after``, the states (keys, ``sps``, ``t3``, ``t2``) of a fold, as they are with ticks that came ``late``.

    ``before`` are the states at some time before all late ticks, ``ticks`` those folded since that time.  Only the keys of
    late ticks are folded again, from there; the others are passed on.
    """
    touched = late.select(*(F.col(k).alias(f"_l{k}") for k in keys)).distinct()
    on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_l{k}")) for k in keys))
    of = lambda df: df.join(touched, on, "left_semi")
    columns = [*keys, *order, score, capacity]
    again = capacity_fold(of(ticks.select(columns)).unionByName(late.select(columns)), keys, order, score, capacity, initial=of(before))
    return after.join(touched, on, "left_anti").select(*keys, "sps", "t3", "t2").unionByName(again)

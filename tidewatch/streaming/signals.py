"""Signals of a tick that arrive as streams of their own, merged when all are there or too late to wait for."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merged(first: DataFrame, others: dict[str, tuple[DataFrame, list[str]]], tick: str, late: str, *, missing: str = "degrade", defaults: dict[str, Column] | None = None) -> DataFrame:
    """Rows of ``first`` with the columns of other streams that have the same tick and keys.

    ``others`` has, by name, a stream and its keys; all streams have the column ``tick``.  Each is a left outer join of
    streams with watermarks: a row whose signal doesn't come is held until the watermark, ``late`` behind the newest tick
    of both, is past its tick, and is let go then, without it.  ``missing`` says how: ``degrade`` fills in ``defaults`` by
    column, or else nulls; ``fail`` ends the stream with the names of the signals.  A signal that comes later than
    that is dropped.  State is what still waits: the rows of ``late`` and no more.
    """
    if missing not in ("degrade", "fail"):
        raise ValueError("what is missing can degrade or fail")
    out, there = first.withWatermark(tick, late), []
    for name, (stream, keys) in others.items():
        mark, own = f"_has_{name}", [tick, *keys]
        side = stream.withWatermark(tick, late).withColumn(mark, F.lit(True)).withColumnsRenamed({k: f"_{name}_{k}" for k in own})
        out = out.join(side, reduce(lambda a, b: a & b, (F.col(k) == F.col(f"_{name}_{k}") for k in own)), "left_outer").drop(*(f"_{name}_{k}" for k in own))
        there.append(mark)
    if missing == "fail":
        lacks = F.array_join(F.array_compact(F.array(*(F.when(F.col(m).isNull(), m.removeprefix("_has_")) for m in there))), ", ")
        out = out.where(F.when(lacks == "", True).otherwise(F.raise_error(F.concat(F.lit("signals are missing: "), lacks)).cast("boolean")))
    filled = {c: F.coalesce(F.col(c), d) for c, d in (defaults or {}).items()}
    return out.withColumns(filled).drop(*there) if filled else out.drop(*there)

"""Series of a range of time: last observations carried forward, step filling and pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import slices


def endpoints(points: DataFrame, series: list[str], start: Column, end: Column, time: str = "ts", value: str = "value", tie: str | None = None) -> DataFrame:
    """``start_value`` and ``end_value`` of each series: the last value at or before the time, at the start else the first
    one after it.  One aggregation; nulls are passed over."""
    order = F.struct(time, *([tie] if tie else []))
    known = F.col(value).isNotNull()
    before = F.max_by(value, F.when(known & (F.col(time) <= start), order))
    after = F.min_by(value, F.when(known & (F.col(time) > start), order))
    last = F.max_by(value, F.when(known & (F.col(time) <= end), order))
    return points.groupBy(*series).agg(F.coalesce(before, after).alias("start_value"), last.alias("end_value"))


def chart(points: DataFrame, series: list[str], start: Column, end: Column, time: str = "ts", value: str = "value", tie: str | None = None) -> DataFrame:
    """Points of each series within (start, end] and one at either end, carried forward."""
    ends = endpoints(points, series, start, end, time, value, tie)
    at = lambda c, v: ends.select(*series, c.alias(time), F.col(v).alias(value)).dropna(subset=[value])
    middle = points.where((F.col(time) > start) & (F.col(time) <= end)).select(*series, time, value)
    return at(start, "start_value").unionByName(middle).unionByName(at(end, "end_value"))


def filled(points: DataFrame, series: list[str], order: list[str], value: str = "value") -> DataFrame:
    """Step interpolation: a null takes the last value before it.  A long series is filled in slices."""
    return slices.last_known(points, series, order, value, "filled")


def numeric_columns(df: DataFrame, *but: str) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in but]


def group_key(*parts: Column) -> Column:
    """Name of a series; missing parts are left out."""
    return F.concat_ws("-", *parts)


def wide(df: DataFrame, time: Column, series: str, names: list[str], value: str, agg=F.max) -> DataFrame:
    """A column for each named series by time: conditional aggregation over a stated list, no pass to find the names."""
    return df.groupBy(time).agg(*(agg(F.when(F.col(series) == n, F.col(value))).alias(n) for n in names))


def melted(df: DataFrame, ids: list[str], metrics: list[str]) -> DataFrame:
    """Long form: a row for each metric."""
    return df.unpivot(ids, metrics, "metric", "value")

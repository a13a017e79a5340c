"""Interactive queries over the change log: wildcards, ranges, search, sorting, pages."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that a query returns at most, and page sizes.
MOST_ROWS, PAGE_SIZES = 20_000, (10, 20, 50, 100)


def checked(dims: dict[str, str | None], start: date, end: date, required: tuple[str, ...] = ()) -> None:
    """Raises ValueError for a missing choice or a range that ends before it starts."""
    if missing := [d for d in required if not dims.get(d)]:
        raise ValueError(f"choose a value or * for {', '.join(missing)}")
    if start > end:
        raise ValueError("the range ends before it starts")


def range_end(start: Column) -> Column:
    """The last day that a query from ``start`` may ask for."""
    return F.least(F.add_months(start, 1), F.current_date())


def wildcard(df: DataFrame, dims: dict[str, str], start, end, time: str = "ts", limit: int = MOST_ROWS, order: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose dimensions have the chosen values (``*``: any) within a range of time that includes both ends.

    Dimensions left open add no predicate, so the others and the range reach the scan.
    """
    picked = [F.col(d) == v for d, v in dims.items() if v != "*"]
    out = df.where(reduce(lambda a, b: a & b, picked, F.col(time).between(start, end)))
    return out.orderBy(time, *order).limit(limit)


def wildcard_by_day(log: DataFrame, dims: dict[str, str], start, end, time: str = "ts", limit: int = MOST_ROWS, order: tuple[str, ...] = ()) -> DataFrame:
    """``wildcard`` over a log that is partitioned by the day ``dt`` of its time: the range names the days, others aren't listed."""
    day = lambda at: F.date_format(F.lit(at).cast("timestamp"), "yyyy-MM-dd")
    return wildcard(log.where(F.col("dt").between(day(start), day(end))), dims, start, end, time, limit, order)


def search(df: DataFrame, text: str, columns: list[str] | None = None) -> DataFrame:
    """Rows with the text in any column, whatever its case."""
    low = F.lit(text.lower())
    return df.where(reduce(lambda a, b: a | b, (F.coalesce(F.contains(F.lower(F.col(c).cast("string")), low), F.lit(False)) for c in columns or df.columns)))


#: What a filter of a column can ask, by name: of the column and the values given.
FILTERS = {
    "contains": lambda c, v: F.contains(F.lower(c.cast("string")), F.lit(str(v).lower())),
    "notContains": lambda c, v: ~F.contains(F.lower(c.cast("string")), F.lit(str(v).lower())),
    "startsWith": lambda c, v: F.startswith(F.lower(c.cast("string")), F.lit(str(v).lower())),
    "endsWith": lambda c, v: F.endswith(F.lower(c.cast("string")), F.lit(str(v).lower())),
    "equals": lambda c, v: c == F.lit(v),
    "notEqual": lambda c, v: ~c.eqNullSafe(F.lit(v)),
    "lessThan": lambda c, v: c < F.lit(v),
    "lessThanOrEqual": lambda c, v: c <= F.lit(v),
    "greaterThan": lambda c, v: c > F.lit(v),
    "greaterThanOrEqual": lambda c, v: c >= F.lit(v),
    "inRange": lambda c, v, w: (c > F.lit(v)) & (c < F.lit(w)),
    "blank": lambda c: c.isNull() | (c.cast("string") == ""),
    "notBlank": lambda c: c.isNotNull() & (c.cast("string") != ""),
}


def filtered(df: DataFrame, filters: dict[str, tuple]) -> DataFrame:
    """Rows that pass a filter for each named column: (name in ``FILTERS``, values); texts are compared whatever their case.
    Numbers, times and texts keep their types, so comparisons reach the scan."""
    return df.where(reduce(lambda a, b: a & b, (FILTERS[how](F.col(c), *values) for c, (how, *values) in filters.items()), F.lit(True)))


def options(keys: DataFrame, chosen: dict[str, str | None], want: str) -> DataFrame:
    """What can be chosen for the dimension ``want``, sorted, given what is chosen for those before it (``*`` or None: open)."""
    picked = [F.col(d) == v for d, v in chosen.items() if d != want and v not in (None, "*")]
    return keys.where(reduce(lambda a, b: a & b, picked, F.col(want).isNotNull())).select(want).distinct().orderBy(want)


def still_valid(keys: DataFrame, chosen: dict[str, str | None], order: list[str]) -> dict[str, str | None]:
    """The choices, in order, with those reset to None that no row has together with the ones before; one row is read."""
    tests, held = [], F.lit(True)
    for d in order:
        if chosen.get(d) not in (None, "*"):
            held = held & (F.col(d) == chosen[d])
        tests.append(F.coalesce(F.bool_or(held), F.lit(False)).alias(d))
    there = keys.agg(*tests).first()
    return {d: chosen.get(d) if there[d] or chosen.get(d) == "*" else None for d in order}


def page(df: DataFrame, number: int, size: int, *order: Column) -> DataFrame:
    """A page of the rows in a total order; the first is 0."""
    if size not in PAGE_SIZES:
        raise ValueError(f"pages have {PAGE_SIZES} rows")
    return df.orderBy(*order).offset(number * size).limit(size)


def normalised(df: DataFrame) -> DataFrame:
    """One spelling of columns that archives name differently, numbers as double, NaN as null."""
    named = {"OnDemand Price": "OndemandPrice", "Spot Price": "SpotPrice", "time": "Time", "SPS_Update_Time": "Time"}
    have = set(df.columns)
    for old, new in named.items():
        if old in have and new not in have:
            df, have = df.withColumnRenamed(old, new), have | {new}
    numbers = {c: F.col(c).try_cast("double") for c in ("OndemandPrice", "SpotPrice", "Savings", "IF") if c in have}
    return df.withColumns({c: F.when(~F.isnan(v), v) for c, v in numbers.items()}) if numbers else df

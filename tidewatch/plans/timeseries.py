"""Queries on series: carried observations, fills, pivots, windows, rate limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.scalars import CAPACITIES
from ..operators import planner, series
from .tables import KEYS, TICKS, read, ticks

START, END = "2024-01-10", "2024-01-20"


def _at(text: str):
    return F.lit(text).cast("timestamp_ntz")


def locf_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.endpoints(read(spark, sf_dir, "events"), KEYS, _at(START), _at(END), tie="event_id")


def locf_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.chart(read(spark, sf_dir, "events"), KEYS, _at(START), _at(END), tie="event_id")


def _gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = ticks(spark, sf_dir)
    return e.select("event_id", *KEYS, "ts", F.when(F.col("k") % 3 != 0, F.col("value")).alias("value"))


def locf_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.filled(_gapped(spark, sf_dir), KEYS, ["ts", "event_id"]).select("event_id", "filled")


def series_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").withColumn("series", series.group_key(F.col("event_type"), (F.col("user_id") % 2).cast("string")))
    return series.wide(e, F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "series", ["view-0", "view-1", "click-0", "click-1"], "value")


def tumbling_10m(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").groupBy(F.window("ts", "10 minutes").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return e.select(F.col("w.start").alias("start"), "event_type", "n")


def tick_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    floor = S.floored(F.col("ts").cast("timestamp"))
    return e.select("event_id", floor.cast("timestamp_ntz").alias("tick"), (floor - F.expr("interval 10 minutes")).cast("timestamp_ntz").alias("before"))


def sliding_62m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planner.rate_windows(read(spark, sf_dir, "events"), ["event_type"], limit=20).select("event_id", "recent", "allowed")


def rotation_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planner.rotation(spark, "2025-02-15 00:00:00", 144, list(CAPACITIES)).select("tick", F.col("ts").cast("timestamp_ntz").alias("ts"), "value")


def credential_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    return c.select("c_custkey", planner.half_swapped(F.col("c_custkey") % 100, F.floor(F.col("c_custkey") / 100) % 2, 100).cast("long").alias("credential"))


def call_headroom(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").where(F.col("ts") >= _at("2024-01-29"))
    return planner.headroom(e, 30, 40)


def time_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise("never")
    return o.select("o_orderkey", S.parsed_time(text, "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd").cast("timestamp_ntz").alias("ts"))


_NAMES = (locf_endpoints, locf_chart, locf_fill, series_pivot, tumbling_10m, tick_floor, sliding_62m, rotation_schedule, credential_swap, call_headroom, time_formats)
QUERIES = {f.__name__: f for f in _NAMES}

_ENDS = f"""SELECT user_id, event_type, coalesce(arg_max(value, (ts, event_id)) FILTER (ts <= TIMESTAMP '{START}' AND value IS NOT NULL), arg_min(value, (ts, event_id)) FILTER (ts > TIMESTAMP '{START}' AND value IS NOT NULL)) AS start_value,
  arg_max(value, (ts, event_id)) FILTER (ts <= TIMESTAMP '{END}' AND value IS NOT NULL) AS end_value FROM events GROUP BY ALL"""
_LABELS = ", ".join(f"max(value) FILTER (event_type = '{t}' AND user_id % 2 = {i}) AS \"{t}-{i}\"" for t in ("view", "click") for i in (0, 1))

ORACLE_SQL = {
    "locf_endpoints": _ENDS,
    "locf_chart": f"""WITH x AS ({_ENDS}) SELECT user_id, event_type, TIMESTAMP '{START}' AS ts, start_value AS value FROM x WHERE start_value IS NOT NULL UNION ALL
      SELECT user_id, event_type, ts, value FROM events WHERE ts > TIMESTAMP '{START}' AND ts <= TIMESTAMP '{END}' UNION ALL
      SELECT user_id, event_type, TIMESTAMP '{END}', end_value FROM x WHERE end_value IS NOT NULL""",
    "locf_fill": f"""{TICKS} SELECT event_id, last_value(CASE WHEN k % 3 <> 0 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM ticks""",
    "series_pivot": f"SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, {_LABELS} FROM events GROUP BY ALL",
    "tumbling_10m": "SELECT time_bucket(INTERVAL '10 minutes', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL",
    "tick_floor": "SELECT event_id, time_bucket(INTERVAL '10 minutes', ts) AS tick, time_bucket(INTERVAL '10 minutes', ts) - INTERVAL '10 minutes' AS before FROM events",
    "sliding_62m": """SELECT event_id, n AS recent, n < 20 AS allowed FROM (SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY epoch_us(ts)
      RANGE BETWEEN 3719999999 PRECEDING AND CURRENT ROW) AS n FROM events)""",
    "rotation_schedule": f"SELECT i AS tick, TIMESTAMP '2025-02-15 00:00:00' + to_minutes(10 * i) AS ts, [{', '.join(map(str, CAPACITIES))}][1 + i % {len(CAPACITIES)}] AS value FROM range(144) t(i)",
    "credential_swap": "SELECT c_custkey, CASE WHEN c_custkey // 100 % 2 = 0 THEN c_custkey % 100 WHEN c_custkey % 100 < 50 THEN c_custkey % 100 + 50 ELSE c_custkey % 100 - 50 END AS credential FROM customer",
    "call_headroom": "SELECT count(*) AS made, 12000 - count(*) AS \"left\" FROM events WHERE ts >= TIMESTAMP '2024-01-29'",
    "time_formats": """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN date_trunc('second', o_orderdate) WHEN o_orderkey % 3 = 0 THEN CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) END AS ts FROM orders""",
}

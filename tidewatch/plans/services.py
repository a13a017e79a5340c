"""Queries on services, streams of signals and tables that are laid out for what is asked of them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import CAPACITIES
from ..operators import diff, query, state
from ..sources import records, rest, sinks
from ..streaming import signals as merging
from ..streaming import ticks as streams
from .relational import ORACLE_SQL as RELATIONAL
from .snapshots import FEATURES, HALVES, _halves, _step_sql
from .snapshots import ORACLE_SQL as SNAPSHOTS
from .tables import KEYS, read, shared_folder


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/services-{uuid.uuid4().hex}"


def _url(folder: str, name: str) -> str:
    return f"{folder if folder.startswith('file:') else 'file://' + folder}/page-{{{name}}}.json"


def paged_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of a service that pages by offset, read until a page is empty."""
    base = _folder(spark)
    sinks.write_pages(read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice"), base, ["p_partkey"], 1000)
    rest.register(spark)
    return spark.read.format("paged_json").schema("p_partkey long, p_brand string, p_retailprice double").options(url=_url(base, "skip"), size=1000, strands=4).load()


def paged_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a service whose pages name the next ones has of one nation's customers."""
    base = _folder(spark)
    sinks.write_pages(read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), base, ["c_custkey"], 500, "next")
    rest.register(spark)
    pages = spark.read.format("paged_json").schema("c_custkey long, c_nationkey int, c_mktsegment string").options(url=_url(base, "token"), token="next", filters="c_nationkey").load()
    return pages.where("c_nationkey = 7")


def paged_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A collection that stops and goes on: the service has had some records, then all; each is read once."""
    base, out = _folder(spark), _folder(spark)
    s = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    middle = s.agg(F.percentile_approx("o_orderkey", 0.37)).first()[0]
    rest.register(spark)
    for part in (s.where(F.col("o_orderkey") <= middle), s):  # the last page of the first part grows
        sinks.write_pages(part, base, ["o_orderkey"], 1000)
        stream = spark.readStream.format("paged_json").schema("o_orderkey long, o_totalprice double").options(url=_url(base, "skip"), size=1000).load()
        write = lambda rows, batch: rows.write.mode("overwrite").parquet(f"{out}/rows/batch={batch}")
        streams.published(stream, write, f"{out}/state", "append").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows").select("o_orderkey", "o_totalprice")


def records_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in a store with commits: one batch is written twice, those that the store rejects are told."""
    path = f"{_folder(spark)}/store"
    s = read(spark, sf_dir, "supplier").withColumn("ts", F.when(F.col("s_suppkey") % 10 != 3, F.lit("2025-02-15 00:10:00").cast("timestamp")))
    s = s.withColumn("s_acctbal", F.when(F.col("s_suppkey") % 7 != 0, F.col("s_acctbal")))
    for part in (0, 1, 0):
        rows = sinks.records(s.where(F.col("s_suppkey") % 2 == part), ["s_name", "s_nationkey"], {"s_acctbal": "DOUBLE"}, F.col("ts"))
        records.publish(rows, path, batch=f"b{part}", size=50)
    named = lambda df, what: df.select(F.get("dimensions", F.lit(0))["value"].alias("name"), F.get("measures", F.lit(0))["value"].cast("double").alias("balance"), "time", what.alias("reason"))
    return named(records.published(spark, path), F.lit(None).cast("string")).unionByName(named(records.published(spark, path, "rejected"), F.col(records.REASON)))


def stream_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three signals by hour and user as streams, one of which lands later; what doesn't come is -1."""
    base, kinds = _folder(spark), {"view": "score", "click": "frequency", "purchase": "price"}
    hourly = read(spark, sf_dir, "events").withColumn("tick", F.date_trunc("hour", "ts").cast("timestamp"))
    hourly = {c: hourly.where(F.col("event_type") == k).groupBy("tick", "user_id").agg(F.max("value").alias(c)) for k, c in kinds.items()}
    last = spark.createDataFrame([(-1,)], "user_id long").withColumn("tick", F.lit("2099-01-01").cast("timestamp"))
    for part in range(3):
        for c, df in hourly.items():
            half = F.pmod(F.hour("tick"), F.lit(2)) == part - (c == "frequency")  # frequencies land a part later
            (df.where(half) if part < 2 or c == "frequency" else df.limit(0)).coalesce(1).write.mode("append").parquet(f"{base}/{c}")
    for c in hourly:
        last.select("tick", "user_id", F.lit(None).cast("double").alias(c)).coalesce(1).write.mode("append").parquet(f"{base}/{c}")
    landed = {c: streams.landed(spark, f"{base}/{c}", spark.read.parquet(f"{base}/{c}").schema, files_per_batch=2) for c in hourly}
    others = {c: (landed[c], ["user_id"]) for c in ("frequency", "price")}
    out = merging.merged(landed["score"], others, "tick", "90 days", defaults={"frequency": F.lit(-1.0), "price": F.lit(-1.0)})
    return streams.drained(out, base, "append").where("user_id >= 0").select(F.col("tick").cast("timestamp_ntz").alias("tick"), "user_id", "score", "frequency", "price")


def _laid_out(spark: SparkSession, halves: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, ...]:
    base = _folder(spark)
    return tuple(sinks.write_laid_out(h, f"half_{uuid.uuid4().hex}", f"{base}/{i}", KEYS, 8) for i, h in enumerate(halves))


def laid_out_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What differs between two snapshots that are tables in buckets of their keys; rows without a key aren't snapshots' rows."""
    return diff.snapshot_diff(*_laid_out(spark, tuple(h.dropna(subset=KEYS) for h in _halves(spark, sf_dir))), KEYS, FEATURES, nulls=False)


def _unknown(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A snapshot with its state and the ticks after it; some of either have no score."""
    at = F.when(F.col("user_id") % 2 == 0, 1).otherwise(5)
    score = F.when(F.col("band") % 4 != 0, 1 + F.col("k"))
    prev, cur = (h.dropna(subset=KEYS).select(*KEYS, score.alias("SPS"), (F.abs("band") * 5 % 55).cast("int").alias("cap")) for h in _halves(spark, sf_dir))
    prev = prev.select(*KEYS, "SPS", F.when(F.col("SPS") >= 3, F.col("cap")).otherwise(0).alias("T3"), F.when(F.col("SPS") >= 2, F.col("cap")).otherwise(0).alias("T2"))
    t3, t2 = state.tick_levels(F.col("SPS"), at)
    return prev, cur.select(*KEYS, "SPS", t3.alias("T3"), t2.alias("T2"), at.alias("TargetCapacity"))


def laid_out_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of one snapshot carried to the next, both tables in buckets of their keys."""
    return state.capacity_step(*_laid_out(spark, _unknown(spark, sf_dir)), KEYS)


def t2t3_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The step where a score that isn't known is -1."""
    return state.capacity_step(*_unknown(spark, sf_dir), KEYS, unknown=-1)


def clustered_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of some dimensions in a range of days, from a log by day whose files are ranges of the dimensions."""
    base = f"{_folder(spark)}/log"
    sinks.append_clustered(read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")), base, ["event_type", "user_id"])
    log = spark.read.parquet(base)
    found = query.wildcard_by_day(log, {"event_type": "click", "user_id": "*"}, F.lit("2024-01-05").cast("timestamp"), F.lit("2024-01-12").cast("timestamp"), order=("event_id",))
    return found.select("event_id", "user_id", "event_type", "value")


def query_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last day that a query may ask for, from each day that has orders."""
    return read(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("start")).distinct().withColumn("end", query.range_end(F.col("start")))


def query_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is told of choices before they are asked: by nation, with a choice that some lack and ranges that some turn round."""
    out = []
    for r in read(spark, sf_dir, "nation").collect():  # 25 rows
        start, end = (f"2024-01-{1 + d:02d}" for d in (r["n_regionkey"], r["n_nationkey"] % 5))
        try:
            query.checked({"nation": r["n_name"], "zone": None if r["n_nationkey"] % 4 == 0 else "*"}, start, end, ("nation", "zone"))
            out.append((r["n_nationkey"], "ok"))
        except ValueError as e:
            out.append((r["n_nationkey"], str(e)))
    return spark.createDataFrame(out, "n_nationkey int, told string")


def capacity_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The capacity that is asked for at the ten-minute tick of each event, in turn."""
    tick = F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 600)
    return read(spark, sf_dir, "events").select("event_id", F.element_at(F.lit(list(CAPACITIES)), (tick % len(CAPACITIES) + 1).cast("int")).alias("capacity"))


_NAMES = (
    paged_offsets, paged_tokens, paged_stream, records_published, stream_signals, laid_out_diff, laid_out_step, t2t3_unknown, clustered_log, query_ranges, query_checks, capacity_turns,
)
QUERIES = {f.__name__: f for f in _NAMES}


def _step(score: str) -> str:
    s = _step_sql("s.SPS", "s.cap", "q.SPS", "q.T3", "q.T2")
    return f"""{HALVES}, b AS (SELECT user_id, event_type, band, {score} AS SPS, CASE WHEN band % 4 <> 0 THEN 1 + k END AS raw FROM p WHERE user_id IS NOT NULL AND event_type IS NOT NULL),
      q AS (SELECT user_id, event_type, SPS, CASE WHEN raw >= 3 THEN abs(band) * 5 % 55 ELSE 0 END AS T3, CASE WHEN raw >= 2 THEN abs(band) * 5 % 55 ELSE 0 END AS T2 FROM b),
      s AS (SELECT user_id, event_type, CASE WHEN user_id % 2 = 0 THEN 1 ELSE 5 END AS cap, {score} AS SPS FROM c WHERE user_id IS NOT NULL AND event_type IS NOT NULL)
      SELECT s.user_id, s.event_type, CAST({s[0]} AS INTEGER) AS SPS, CAST({s[1]} AS INTEGER) AS T3, CAST({s[2]} AS INTEGER) AS T2, s.cap AS TargetCapacity FROM s LEFT JOIN q USING (user_id, event_type)"""


ORACLE_SQL = {
    "paged_offsets": "SELECT p_partkey, p_brand, p_retailprice FROM part",
    "paged_tokens": "SELECT c_custkey, CAST(c_nationkey AS INTEGER) AS c_nationkey, c_mktsegment FROM customer WHERE c_nationkey = 7",
    "paged_stream": "SELECT o_orderkey, o_totalprice FROM orders",
    "records_published": """SELECT s_name AS name, CASE WHEN s_suppkey % 7 <> 0 THEN s_acctbal END AS balance, CASE WHEN s_suppkey % 10 <> 3 THEN CAST(epoch_ms(TIMESTAMP '2025-02-15 00:10:00') AS VARCHAR) END AS time,
      CASE WHEN s_suppkey % 10 = 3 THEN 'no time' WHEN s_suppkey % 7 = 0 THEN 'no measure' END AS reason FROM supplier""",
    "stream_signals": """WITH h AS (SELECT date_trunc('hour', ts) AS tick, user_id, event_type, max(value) AS v FROM events GROUP BY ALL)
      SELECT CAST(s.tick AS TIMESTAMP) AS tick, s.user_id, s.v AS score, coalesce(f.v, -1) AS frequency, coalesce(p.v, -1) AS price FROM h s LEFT JOIN h f ON f.event_type = 'click' AND f.tick = s.tick AND f.user_id = s.user_id
      LEFT JOIN h p ON p.event_type = 'purchase' AND p.tick = s.tick AND p.user_id = s.user_id WHERE s.event_type = 'view' AND s.user_id IS NOT NULL""",
    "laid_out_diff": SNAPSHOTS["snapshot_diff"],
    "laid_out_step": _step("CASE WHEN band % 4 <> 0 THEN 1 + k END"),
    "t2t3_unknown": _step("coalesce(CASE WHEN band % 4 <> 0 THEN 1 + k END, -1)"),
    "clustered_log": RELATIONAL["wildcard_query"],
    "query_ranges": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS start, CAST(least(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH, current_date) AS DATE) AS \"end\" FROM orders",
    "query_checks": """SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN 'choose a value or * for zone' WHEN n_regionkey > n_nationkey % 5 THEN 'the range ends before it starts' ELSE 'ok' END AS told FROM nation""",
    "capacity_turns": f"SELECT event_id, [{', '.join(map(str, CAPACITIES))}][1 + CAST(floor(epoch(ts) / 600) AS BIGINT) % {len(CAPACITIES)}] AS capacity FROM events",
}

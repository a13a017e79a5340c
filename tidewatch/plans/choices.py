"""Queries on choices and state: filters of columns, options that depend on each other, maps, requests, allocation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import diff, index, merge, planner, query
from ..sources import sinks
from .tables import KEYS, TICKS, read, ticks


def column_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    return query.filtered(p, {"p_size": ("inRange", 5, 40), "p_type": ("notContains", "promo"), "p_brand": ("startsWith", "brand#"), "p_retailprice": ("greaterThanOrEqual", 905.0), "p_name": ("notBlank",)})


def cascading_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions that a segment has customers in; nations of that region; and choices that no longer go together."""
    n = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    keys = read(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_mktsegment", "r_name", "n_name")
    segment = F.col("c_mktsegment")
    first = keys.agg(F.min(segment).alias("s"), F.min_by("r_name", F.struct(segment, "r_name")).alias("r")).first()
    chosen = {"c_mktsegment": first["s"], "r_name": first["r"], "n_name": "NOWHERE"}
    regions = query.options(keys, {"c_mktsegment": first["s"]}, "r_name").select(F.lit("region").alias("what"), F.col("r_name").alias("value"))
    nations = query.options(keys, {"c_mktsegment": first["s"], "r_name": first["r"]}, "n_name").select(F.lit("nation").alias("what"), F.col("n_name").alias("value"))
    left = query.still_valid(keys, chosen, list(chosen))
    kept = spark.createDataFrame([(f"kept {k}", v) for k, v in left.items()], "what string, value string")
    return regions.unionByName(nations).unionByName(kept)


def lookup_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as one map, with a key of one and of two columns, and looked up again."""
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey", "n_name")
    one = index.value_map(n, F.col("n_nationkey"), F.col("n_name")).withColumnRenamed("map", "one")
    two = index.value_map(n, F.struct("n_regionkey", "n_nationkey"), F.col("n_name")).withColumnRenamed("map", "two")
    s = read(spark, sf_dir, "supplier").join(n.select("n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"))
    s = s.crossJoin(F.broadcast(one)).crossJoin(F.broadcast(two))  # one row each
    return s.select("s_suppkey", F.col("one")[F.col("s_nationkey")].alias("name"), F.col("two")[F.struct("n_regionkey", "n_nationkey")].alias("same"))


def request_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of 30 sizes at most, as JSON, read back."""
    p = read(spark, sf_dir, "part").select((F.col("p_size") % 4).cast("string").alias("region"), F.concat(F.lit("s"), F.col("p_partkey").cast("string")).alias("size"), F.concat(F.lit("/id/"), F.col("p_partkey").cast("string")).alias("resource"), F.floor(F.col("p_partkey") / 30).alias("g"))
    bodies = p.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("region", "size", "resource"))).alias("all")).select("g", S.spec_request(F.col("all"), "sub").alias("body"))
    item = "struct<id:string,firstParty:array<struct<id:string,resourceId:string,quantity:int>>,thirdParty:array<string>>"
    back = bodies.select("g", F.from_json("body", f"subscriptionId string, specResourceSets array<{item}>, specsToAllowZeroCost array<string>, specType string").alias("b"))
    rows = index.flattened(back.select("g", "b.subscriptionId", "b.specType", F.size("b.specsToAllowZeroCost").alias("n"), F.col("b.specResourceSets").alias("item")), "item")
    region, size = S.place_and_size(F.col("item.id"))
    return rows.select("g", "subscriptionId", "specType", "n", region.alias("region"), size.alias("size"), S.path_part(F.col("item.firstParty")[0]["resourceId"], 3).alias("resource"), F.col("item.firstParty")[0]["quantity"].alias("quantity"))


def valid_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists without the items known to be invalid; a list of which nothing is left is null."""
    c = read(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.array_sort(F.collect_set("c_mktsegment")).alias("all"))
    bad = F.when(F.col("c_nationkey") % 5 == 0, F.col("all")).when(F.col("c_nationkey") % 5 != 1, F.slice("all", 1, 2))
    return c.select("c_nationkey", F.array_join(S.without_items(F.col("all"), bad), ",").alias("left"))


def day_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = S.day_bounds(F.col("ts"))
    return read(spark, sf_dir, "events").select("event_id", start.cast("timestamp_ntz").alias("start"), end.cast("timestamp_ntz").alias("end"))


def names_shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log names of subscriptions, colours of series, kinds of failures; the table from its end."""
    c = read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    reason = F.when(k % 4 == 0, "Container OutOfMemory").when(k % 4 == 1, "Job timeout reached").otherwise("Essential container exited")
    code = F.when(k % 4 == 2, (k % 3).cast("int"))
    sub = F.concat(F.lit("ab"), k.cast("string"), F.lit("-cd-ef"))
    rows = c.select("c_custkey", S.log_name(sub).alias("log"), F.round(S.hue(k), 6).alias("hue"), S.failure_kind(reason, code).alias("failure"), S.joined_key(F.col("c_mktsegment"), k.cast("string")).alias("key"))
    return rows.orderBy(F.desc("c_custkey"))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a subscription and a location with their calls: customers of a nation by segment."""
    n = read(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    seg = F.dense_rank().over(_order("c_mktsegment")) - 1
    n = n.withColumn("i", seg).where("c_nationkey < 5")
    return n.select(F.concat(F.lit("sub"), F.col("c_nationkey").cast("string")).alias("subscription"), F.col("c_mktsegment").alias("location"), (F.col("c_nationkey") * 5 + F.col("i")).cast("int").alias("place"), (F.col("n") % 12).alias("recent"), (F.col("n") % 7 == 0).alias("over_limit"))


def _order(c: str):
    from pyspark.sql import Window

    return Window.orderBy(c)  # some segments


def calls_allocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pair for each request in turn, passing over those without room; requests beyond all room get none."""
    requests = spark.range(150).select(F.col("id").alias("request"))
    pairs = _pairs(spark, sf_dir)
    places = pairs.count()
    pairs = pairs.withColumn("place", (F.row_number().over(_order("place")) - 1).cast("int"))
    return planner.allocated_with_room(requests, ["request"], pairs, after=places // 2).select("request", "subscription", "location")


def credentials_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests keep their credential; new ones take the next."""
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("request"))
    known = s.where("request % 3 = 0").select("request", (F.col("request") * 2).alias("credential"))
    return planner.credentials_kept(s, known, "request", start=5)


def calls_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether there is room for a call, with some groups marked as over their limit."""
    e = read(spark, sf_dir, "events")
    return planner.rate_windows(e, ["user_id"], limit=2, over_limit=F.col("user_id") % 4 == 0).select("event_id", "recent", "allowed")


def pairs_completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The call state with an entry for each pair."""
    n, r = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    state = n.select(F.col("n_name").alias("subscription"), F.col("n_regionkey").cast("string").alias("location"), F.col("n_nationkey").alias("calls"))
    return planner.with_missing_pairs(state, n.select(F.col("n_name").alias("subscription")), r.select(F.col("r_regionkey").cast("string").alias("location")))


def rounded_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices that differ once rounded to two decimals."""
    p = read(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("price"), "p_size")
    cur = p.select("p_partkey", (F.col("price") + (F.col("p_partkey") % 4) * 0.002).alias("price"), "p_size").where("p_partkey % 9 <> 0")
    return diff.snapshot_diff(p, cur, ["p_partkey"], ["price", "p_size"], places={"price": 2}).select("p_partkey", F.round("price", 6).alias("price"), F.round("prev_price", 6).alias("prev_price"), "change")


def spellings_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that archives name differently, numbers that are text, NaN."""
    o = read(spark, sf_dir, "orders")
    raw = F.when(F.col("o_orderkey") % 5 == 0, "NaN").when(F.col("o_orderkey") % 7 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    rows = o.select("o_orderkey", raw.alias("OnDemand Price"), F.col("o_totalprice").alias("Spot Price"), F.col("o_orderdate").alias("SPS_Update_Time"))
    out = query.normalised(rows)
    return out.select("o_orderkey", "OndemandPrice", "SpotPrice", "Time")


def single_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one node or of no stated number, zeros marked, and the first of several spellings of a column."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.element_at(F.lit([1, -1, 2, 5]), (F.col("o_orderkey") % 4 + 1).cast("int")).alias("DesiredCount"), (F.col("o_orderkey") % 3).alias("Score"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("A"), F.col("o_orderpriority").alias("B"))
    rows = sinks.zeros_marked(sinks.single_node(o), ["Score"])
    return rows.select("o_orderkey", "DesiredCount", "Score", merge.first_column(rows, "A", "missing", "B").alias("either"))


def ticks_enough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that several ticks have with the same value, as the check for repeated keys tells them."""
    return diff.duplicate_keys(ticks(spark, sf_dir).select(*KEYS, "k"), [*KEYS, "k"])


_NAMES = (
    column_filters, cascading_options, lookup_maps, request_bodies, valid_items, day_bounds, names_shown, calls_allocated, credentials_mapped, calls_limited, pairs_completed, rounded_diff,
    spellings_normalised, single_nodes, ticks_enough,
)
QUERIES = {f.__name__: f for f in _NAMES}

ORACLE_SQL = {
    "column_filters": """SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part WHERE p_size > 5 AND p_size < 40 AND p_type NOT ILIKE '%promo%' AND lower(p_brand) LIKE 'brand#%'
      AND p_retailprice >= 905 AND p_name IS NOT NULL AND p_name <> ''""",
    "cascading_options": """WITH k AS (SELECT DISTINCT c_mktsegment AS s, r_name AS r, n_name AS n FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey), f AS (SELECT s, r FROM k ORDER BY s, r LIMIT 1)
      SELECT DISTINCT 'region' AS what, r AS value FROM k WHERE s = (SELECT s FROM f) UNION ALL SELECT DISTINCT 'nation', n FROM k WHERE (s, r) IN (SELECT s, r FROM f)
      UNION ALL SELECT 'kept c_mktsegment', s FROM f UNION ALL SELECT 'kept r_name', r FROM f UNION ALL SELECT 'kept n_name', NULL""",
    "lookup_maps": "SELECT s_suppkey, n_name AS name, n_name AS same FROM supplier JOIN nation ON n_nationkey = s_nationkey",
    "request_bodies": """SELECT p_partkey // 30 AS g, 'sub' AS subscriptionId, 'Microsoft_Azure_Compute' AS specType, CAST(count(*) OVER (PARTITION BY p_partkey // 30) AS INTEGER) AS n, CAST(p_size % 4 AS VARCHAR) AS region,
      's' || p_partkey AS size, CAST(p_partkey AS VARCHAR) AS resource, 1 AS quantity FROM part""",
    "valid_items": """WITH d AS (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer), r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment) AS i FROM d)
      SELECT c_nationkey, string_agg(c_mktsegment, ',' ORDER BY c_mktsegment) FILTER (CASE c_nationkey % 5 WHEN 0 THEN false WHEN 1 THEN true ELSE i > 2 END) AS "left" FROM r GROUP BY ALL""",
    "day_bounds": "SELECT event_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS start, CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL '1 day' - INTERVAL '1 millisecond' AS \"end\" FROM events",
    "names_shown": """SELECT c_custkey, 'ab' || c_custkey AS log, round(c_custkey * 137.508::DOUBLE % 360, 6) AS hue, CASE WHEN c_custkey % 4 = 0 THEN 'out of memory' WHEN c_custkey % 4 = 1 THEN 'timeout'
      WHEN c_custkey % 4 = 2 AND c_custkey % 3 > 0 THEN 'exit code ' || c_custkey % 3 ELSE 'unknown' END AS failure, c_mktsegment || '_' || c_custkey AS key FROM customer""",
    "calls_allocated": """WITH n AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL), s AS (SELECT *, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS i FROM n),
      p AS (SELECT 'sub' || c_nationkey AS subscription, c_mktsegment AS location, row_number() OVER (ORDER BY c_nationkey * 5 + i) - 1 AS place, CASE WHEN n % 7 = 0 THEN 0 ELSE greatest(10 - n % 12, 0) END AS room, count(*) OVER () AS c FROM s WHERE c_nationkey < 5),
      t AS (SELECT subscription, location, (place - (c // 2 + 1) + 2 * c) % c AS turn, unnest(range(1, CAST(room AS BIGINT) + 1)) AS round FROM p),
      k AS (SELECT *, row_number() OVER (ORDER BY round, turn) - 1 AS request FROM t) SELECT r.request, subscription, location FROM range(150) r(request) LEFT JOIN k USING (request)""",
    "credentials_mapped": """SELECT s_suppkey AS request, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey * 2 ELSE (SELECT greatest(coalesce(max(s_suppkey * 2) + 1, 5), 5) FROM supplier WHERE s_suppkey % 3 = 0)
      + row_number() OVER (PARTITION BY s_suppkey % 3 = 0 ORDER BY s_suppkey) - 1 END AS credential FROM supplier""",
    "calls_limited": """SELECT event_id, n AS recent, n < 2 AND user_id % 4 <> 0 AS allowed FROM (SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts)
      RANGE BETWEEN 3719999999 PRECEDING AND CURRENT ROW) AS n FROM events)""",
    "pairs_completed": """SELECT n_name AS subscription, CAST(r_regionkey AS VARCHAR) AS location, CASE WHEN n_regionkey = r_regionkey THEN n_nationkey END AS calls FROM nation, region""",
    "rounded_diff": """WITH c AS (SELECT p_partkey, p_retailprice AS before, CASE WHEN p_partkey % 9 <> 0 THEN p_retailprice + (p_partkey % 4) * 0.002::DOUBLE END AS price FROM part)
      SELECT p_partkey, round(price, 6) AS price, round(before, 6) AS prev_price, CASE WHEN price IS NULL THEN 'removed' ELSE 'changed' END AS change FROM c WHERE price IS NULL OR round(price, 2) <> round(before, 2)""",
    "spellings_normalised": """SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 THEN o_totalprice END AS OndemandPrice, o_totalprice AS SpotPrice, o_orderdate AS Time FROM orders""",
    "single_nodes": """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE -1 END AS DesiredCount, CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_orderkey % 3 END AS Score,
      CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE o_orderpriority END AS either FROM orders WHERE o_orderkey % 4 < 2""",
    "ticks_enough": f"{TICKS} SELECT user_id, event_type, k, count(*) AS n FROM ticks GROUP BY ALL HAVING count(*) > 1",
}
